"""Every query with a SQL text against DuckDB, and the registry itself."""

import harness
import pytest

import __spark_entry__ as contract

ORACLES = contract.oracle_sql()
ROWS_ONLY = sorted(set(contract.queries()) - set(ORACLES))
# The operators of skyweave.llm have tests of their own; what fits models is exercised in test_learning as well.
CORPUS = {n for n in contract.queries() if n.startswith("op") and n[2:3].isdigit()} | {"pipeline"}
FITTED = {
    "ml_logistic", "ml_forest", "ml_boosting", "ml_compare", "ml_quality",
    "batch_score", "score_with_lookup", "scoring_quality", "stream_score", "alias_move",
}


@pytest.mark.parametrize("name", sorted(set(ORACLES) - CORPUS))
def test_same_rows(spark, con, folder, name, monkeypatch):
    if name in FITTED:
        from skyweave.plans import learning

        monkeypatch.setattr(learning, "FOREST_TREES", 10)
        monkeypatch.setattr(learning, "FOREST_DEPTH", 6)
        monkeypatch.setattr(learning, "BOOSTING_ROUNDS", 5)
    found = harness.differences(contract.queries()[name](spark, folder), con, ORACLES[name])
    assert not found, found


@pytest.mark.parametrize("name", [n for n in ROWS_ONLY if n not in FITTED | CORPUS])
def test_gives_rows(spark, folder, name):
    assert contract.queries()[name](spark, folder).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(contract.queries())


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert {r.flight_phase for r in rows} == {"Ground", "Climb", "Descent", "Cruise"}
    assert abs(sum(r.pct for r in rows) - 100) < 0.01


SEQUENCES = [
    "cdc_scd2",
    "asof_features",
    "feature_summary",
    "box_plot",
    "entity_tracks",
    "downsample_tracks",
    "altitude_delta",
    "rolling_features_day",
    "stale_fix",
    "holding_loops_long",
    "flight_segments_long",
    "step_distance",
]


@pytest.mark.parametrize("name", SEQUENCES)
def test_same_rows_when_sliced(spark, con, folder, name, monkeypatch):
    from skyweave.operators import sequence

    monkeypatch.setattr(sequence, "TARGET_ROWS", 150)
    found = harness.differences(contract.queries()[name](spark, folder), con, ORACLES[name])
    assert not found, found


PARTITION_SENSITIVE = ["uniform_sample", "stratified_sample", "stratified_split", "random_row_per_key", "entity_tracks"]


@pytest.mark.parametrize("name", PARTITION_SENSITIVE)
def test_independent_of_partitions(spark, con, folder, name):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for count in (1, 16):
            spark.conf.set("spark.sql.shuffle.partitions", str(count))
            found = harness.differences(contract.queries()[name](spark, folder), con, ORACLES[name])
            assert not found, (count, found)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
