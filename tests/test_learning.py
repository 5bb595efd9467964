"""Fitted models: shape, invariants, and sane quality. Small forests keep the test short."""

import pytest
from pyspark.sql import functions as F

from skyweave.functions.labels import PHASES
from skyweave.operators import evaluate, features
from skyweave.operators.features import AIRCRAFT_FEATURES, ROW_FEATURES
from skyweave.plans import learning
from skyweave.queries.base import curated
from skyweave.queries.learning import LABEL, parts
from skyweave.session import scratch_path
from skyweave.sources.sinks import keyed_table


@pytest.fixture(scope="module")
def split_rows(spark, folder):
    return parts(spark, folder)


def test_no_row_is_in_both_parts(split_rows):
    train, held_out = split_rows
    assert train.join(held_out, "event_id").count() == 0
    share = train.count() / (train.count() + held_out.count())
    assert 0.75 < share < 0.85


def test_the_cap_bounds_the_fit_alone(spark, folder, split_rows, monkeypatch):
    monkeypatch.setattr(learning, "TRAIN_ROWS", 100)
    train, held_out = parts(spark, folder)
    assert 60 < train.count() < 140
    assert held_out.count() == split_rows[1].count()
    model = learning.fit(learning.LOGISTIC, train, ROW_FEATURES)
    rows = curated(spark, folder)
    assert learning.gold_predictions(model, rows, ["event_id"]).count() == rows.count()


@pytest.mark.parametrize("candidate", [learning.LOGISTIC, learning.FOREST])
def test_null_features_do_not_decide(split_rows, candidate, monkeypatch):
    """Without one feature the labels still follow the others; they used to be all the same."""
    monkeypatch.setattr(learning, "FOREST_TREES", 10)
    train, held_out = split_rows
    model = learning.fit(candidate, train, ROW_FEATURES)
    blind = held_out.withColumn("velocity", F.lit(None).cast("double"))
    scored = learning.score(model, blind)
    assert scored.columns == [*blind.columns, f"{LABEL}_pred"]
    labels = {r[0]: r[1] for r in scored.groupBy(f"{LABEL}_pred").count().collect()}
    assert len(labels) > 1 and None not in labels and sum(labels.values()) == held_out.count()
    as_seen = learning.score(model, held_out).select("event_id", F.col(f"{LABEL}_pred").alias("seen"))
    same = scored.join(as_seen, "event_id").where(F.col(f"{LABEL}_pred") == F.col("seen")).count()
    assert same > 0.6 * held_out.count()


@pytest.mark.parametrize("candidate", [learning.LOGISTIC, learning.FOREST, learning.BOOSTING])
def test_candidates_learn(split_rows, candidate, monkeypatch):
    monkeypatch.setattr(learning, "FOREST_TREES", 10)
    monkeypatch.setattr(learning, "FOREST_DEPTH", 6)
    train, held_out = split_rows
    model = learning.fit(candidate, train, ROW_FEATURES, rounds=3)
    scored = learning.score(model, held_out)
    assert scored.count() == held_out.count()
    assert {r[0] for r in scored.select(f"{LABEL}_pred").distinct().collect()} <= set(PHASES)
    assert evaluate.macro_f1(scored, LABEL, f"{LABEL}_pred").first().macro_f1 > 0.4
    gold = learning.gold_predictions(model, held_out, ["icao24", *ROW_FEATURES])
    assert gold.columns == ["icao24", *ROW_FEATURES, f"{LABEL}_actual", f"{LABEL}_pred", "scored_at"]


def test_model_brings_its_lookup(spark, folder, split_rows):
    train, held_out = split_rows
    root = scratch_path(spark, "test-lookup")
    table = keyed_table(features.entity_features(curated(spark, folder)), f"{root}/f", ["icao24"])
    made = features.training_set(train, table, "icao24", AIRCRAFT_FEATURES, ROW_FEATURES, LABEL)
    model = learning.fit(learning.LOGISTIC, made, ROW_FEATURES + AIRCRAFT_FEATURES)
    learning.save_with_lookup(model, f"{root}/m", table=f"{root}/f", key="icao24", names=AIRCRAFT_FEATURES)
    stranger = held_out.limit(1).withColumn("icao24", F.lit("ffffff"))
    scored = learning.score_with_lookup(spark, f"{root}/m", held_out.unionByName(stranger))
    # An unknown key still gets a row; its looked-up features are null.
    assert scored.count() == held_out.count() + 1
    unknown = scored.where("icao24 = 'ffffff' AND avg_velocity IS NULL").collect()
    assert len(unknown) == 1 and unknown[0][f"{LABEL}_pred"] in PHASES


def test_alias_moves(spark):
    registry = learning.ModelTable(spark, scratch_path(spark, "test-models"))
    versions = spark.createDataFrame([("m", 1, "a", 0.5), ("m", 2, "b", 0.6)], "model string, version bigint, candidate string, macro_f1 double")
    registry.register(versions)
    registry.point("prod", versions.where("version = 2"), 1)
    registry.point("prod", versions.where("version = 1"), 2)
    assert [(r.alias, r.version) for r in registry.resolve().collect()] == [("prod", 1)]
    with pytest.raises(LookupError):
        registry.load("m", "prod")


def test_an_alias_loads_what_it_points_to(spark, split_rows, monkeypatch):
    monkeypatch.setattr(learning, "FOREST_TREES", 5)
    train, held_out = split_rows
    fits = {c: learning.fit(c, train, ROW_FEATURES) for c in (learning.FOREST, learning.LOGISTIC)}
    tie = spark.createDataFrame([(c, 0.5) for c in fits], "candidate string, macro_f1 double")
    registry = learning.ModelTable(spark, scratch_path(spark, "test-registry"))
    versions = registry.store("m", fits, tie)
    # A tie goes to the first name.
    assert [r.candidate for r in learning.promote(registry, "m", 1).collect()] == [learning.LOGISTIC]
    registry.point("prod", versions.where(F.col("candidate") == learning.FOREST), 2)
    model, candidate = registry.load("m", "prod")
    assert candidate == learning.FOREST
    one, two = (learning.score(m, held_out).orderBy("event_id").collect() for m in (model, fits[learning.FOREST]))
    assert one == two
    runs = {(r.run, r.kind, r.name) for r in registry.runs().collect()}
    assert (learning.FOREST, "param", "trees") in runs and (learning.LOGISTIC, "metric", "macro_f1") in runs


def test_stored_rows_are_scored_on_all_cores(spark):
    class Same:
        def transform(self, df):
            return df.withColumn(f"{learning.LABEL}_pred", F.lit("Climb"))

    scored = learning.score(Same(), spark.range(0, 1000, 1, 1))
    assert scored.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert scored.count() == 1000 and scored.columns == ["id", "flight_phase_pred"]
