"""Streams with state of their own: live positions, late changes, schemas that follow, summaries merged by batch."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from skyweave.operators import changes
from skyweave.operators.regions import regional_summary, route
from skyweave.operators.rules import SILVER_DROP, SILVER_WARN, expectation_metrics, keep_passing
from skyweave.plans import medallion
from skyweave.session import scratch_path
from skyweave.sources.telemetry import state_vectors, table, to_state_vectors
from skyweave.streaming import history, ingest, live, run, summaries

POSITIONS = "icao24 string, event_id long, time_position timestamp_ntz, velocity double"


def take_back(root):
    """The last batch, as if its commit had been lost."""
    commits = Path(root, "checkpoint", "commits")
    last = max(int(p.name) for p in commits.iterdir() if p.name.isdigit())
    for p in (commits / str(last), commits / f".{last}.crc"):
        p.unlink(missing_ok=True)


def positions(spark, path, rows):
    df = spark.createDataFrame([(k, i, t, v) for k, i, t, v in rows], "icao24 string, event_id long, t string, velocity double")
    df.select("icao24", "event_id", F.col("t").cast("timestamp_ntz").alias("time_position"), "velocity").coalesce(1).write.mode(
        "append"
    ).parquet(path)


def test_live_positions_fall_silent_and_come_back(spark):
    path, root = scratch_path(spark, "positions"), scratch_path(spark, "live")

    def now():
        stream = run.file_stream(spark, path, files_per_batch=1)
        found = live.live_positions(stream, root, "2 hours", "10 minutes")
        return {r.icao24: (r.event_id, str(r.time_position)[11:16], r.status) for r in found.collect()}

    positions(spark, path, [("a", 1, "2024-01-01 00:00:00", 1.0), ("b", 2, "2024-01-01 00:05:00", None), ("a", 3, "2024-01-01 00:00:00", 2.0)])
    assert now() == {"a": (3, "00:00", "live"), "b": (2, "00:05", "live")}
    positions(spark, path, [("c", 4, "2024-01-01 02:12:00", 1.0), ("d", 5, None, 1.0)])
    # The watermark is 02:02, past 00:00 and two hours; 00:05 is not yet.
    assert now() == {"a": (3, "00:00", "silent"), "b": (2, "00:05", "live"), "c": (4, "02:12", "live")}
    positions(spark, path, [("a", 6, "2024-01-01 03:00:00", 1.0), ("b", 7, "2024-01-01 03:01:00", 1.0), ("b", 8, "2024-01-01 00:01:00", 1.0)])
    expected = {"a": (6, "03:00", "live"), "b": (7, "03:01", "live"), "c": (4, "02:12", "live")}
    assert now() == expected
    take_back(root)
    assert now() == expected
    assert now() == expected


FEED = "k long, seq long, v string, gone boolean"


@pytest.mark.parametrize("cut", [[12], [3, 3, 3, 3], [1] * 12])
def test_any_batches_give_the_same_history(spark, cut):
    rows = [
        (1, 5, "e", False), (1, 1, "a", False), (2, 4, "x", False), (1, 3, "c", True), (2, 2, "w", False), (1, 3, "c", True),
        (3, 1, "p", True), (1, 2, "b", False), (2, 9, "z", True), (1, 4, "d", False), (None, 1, "n", False), (4, None, "n", False),
    ]
    path, roots = scratch_path(spark, "feed"), [scratch_path(spark, n) for n in ("one", "two")]
    at = 0
    for n in cut:
        spark.createDataFrame(rows[at : at + n], FEED).coalesce(1).write.mode("append").parquet(path)
        at += n
        stream = lambda: run.file_stream(spark, path, files_per_batch=1)
        first = history.current_state(stream(), roots[0], "k", "seq", F.col("gone"), folders=4)
        second = history.state_history(stream(), roots[1], "k", "seq", F.col("gone"), folders=4)
    take_back(roots[0])
    take_back(roots[1])
    first = history.current_state(stream(), roots[0], "k", "seq", F.col("gone"), folders=4)
    second = history.state_history(stream(), roots[1], "k", "seq", F.col("gone"), folders=4)
    whole = spark.createDataFrame(rows, FEED).where("k is not null and seq is not null").distinct()
    expected = changes.apply_latest(whole, "k", "seq", F.col("gone")).select("k", "seq", "v", "gone")
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, expected.collect()))
    names = ["k", "valid_from", "v", "gone", "valid_to", "is_current"]
    expected = changes.apply_history(whole, "k", "seq", F.col("gone")).select(names)
    assert sorted(map(str, second.select(names).collect())) == sorted(map(str, expected.collect()))


def test_only_touched_ranges_are_rewritten(spark):
    path, root = scratch_path(spark, "feed"), scratch_path(spark, "ranges")
    spark.createDataFrame([(k, 1, "a", False) for k in range(40)], FEED).write.parquet(path)
    stream = lambda: run.file_stream(spark, path)
    history.state_history(stream(), root, "k", "seq", F.col("gone"), folders=8)
    files = lambda: {p.parent.name: p.name for p in Path(root, "history").rglob("*.parquet")}
    before = files()
    spark.createDataFrame([(7, 2, "b", False)], FEED).write.mode("append").parquet(path)
    found = history.state_history(stream(), root, "k", "seq", F.col("gone"), folders=8)
    after = files()
    assert len(before) == 8 and sum(before[f] != after[f] for f in before) == 1
    assert sorted((r.valid_from, r.valid_to) for r in found.where("k = 7").collect()) == [(1, 2), (2, None)]


@pytest.mark.parametrize("apply", [history.current_state, history.state_history])
def test_what_is_written_does_not_grow_with_the_batches(spark, monkeypatch, apply):
    path, root = scratch_path(spark, "feed"), scratch_path(spark, "many")
    rows = [(k, s, f"{k}-{s}", False) for s in range(24) for k in range(50)]
    for at in range(0, len(rows), 50):
        spark.createDataFrame(rows[at : at + 50], FEED).coalesce(1).write.mode("append").parquet(path)
    folds, fold = [], history._fold
    monkeypatch.setattr(history, "_fold", lambda *a: (folds.append(1), fold(*a)))
    found = apply(run.file_stream(spark, path, files_per_batch=1), root, "k", "seq", F.col("gone"), folders=2)
    # Before, each of the 24 batches rewrote the table.
    assert len(folds) < 14
    assert found.count() == (50 if apply is history.current_state else 1200)
    if apply is history.state_history:
        assert found.where("is_current = (valid_from = 23) and (is_current or valid_to = valid_from + 1)").count() == 1200
    waiting = [p for p in Path(root).glob("*-waiting/*") if not p.name.startswith(".")]
    assert not waiting


def test_schema_follows_the_deliveries(spark):
    landing, root = scratch_path(spark, "landing"), scratch_path(spark, "evolving")
    evolving = ingest.EvolvingTable(spark, root)

    def deliver(*lines):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(landing)
        return sorted(map(lambda r: r.asDict(), evolving.ingest(landing).collect()), key=str)

    assert evolving.read().columns == ["rescued"]
    deliver('{"id": 1, "x": 2, "empty": null}', '{"id": 2, "x": 2.5, "deep": {"a": [1]}}', "")
    assert evolving.columns() == {"deep": "string", "id": "bigint", "x": "double"}
    deliver('{"id": "three", "x": 1, "on": true}', "no json", "[1]", '{"ID": 9, "id": 4, "it\'s": "q", "on": "yes"}')
    assert evolving.columns() == {"deep": "string", "id": "bigint", "x": "double", "it's": "string", "on": "string"}
    rows = deliver('{"on": 5, "id": 1.5, "rescued": 1, "empty": 0, "both\\"\'": 7}')
    assert evolving.columns()["empty"] == "bigint"
    by_rescued = {r["rescued"]: r for r in rows if r["rescued"]}
    found = {json.dumps(json.loads(k), sort_keys=True) for k in by_rescued}
    assert found == {'{"id": "three"}', '{"_line": "no json"}', '{"_line": "[1]"}', '{"ID": "9"}', json.dumps({"both\"'": "7", "id": "1.5", "rescued": "1"})}
    assert [r["deep"] for r in rows if r["deep"]] == ['{"a":[1]}'] and len(rows) == 7
    assert sorted(r["id"] for r in rows if r["id"]) == [1, 2, 4]
    assert evolving.versions().count() == 3
    take_back(root)
    again = sorted((r.asDict() for r in evolving.ingest(landing).collect()), key=str)
    assert again == rows and evolving.versions().count() == 3


def test_second_delivery_rewrites_its_regions_only(spark, folder):
    source, root = scratch_path(spark, "test-source"), scratch_path(spark, "test-merged")
    events = table(spark, folder, "events")
    far = state_vectors(spark, folder).where("longitude between -100 and -50").select("event_id")
    events.join(far, "event_id", "left_anti").write.parquet(source)
    medallion.build(spark, source, root=root)
    files = lambda: {p.parent.name: p.name for p in Path(root, "summary", "table").rglob("*.parquet")}
    before = files()
    events.join(far, "event_id", "left_semi").write.mode("append").parquet(source)
    built = medallion.build(spark, source, root=root)
    after = files()
    assert {r for r in after if after[r] != before[r]} == {"region=Americas"}
    expected = regional_summary(route(keep_passing(state_vectors(spark, folder), SILVER_DROP)))
    got = medallion.read_summary(spark, built).select(expected.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))


def test_key_sets_are_compacted(spark):
    root, seen = scratch_path(spark, "compacted"), set()
    schema = "icao24 string, region string, velocity double, baro_altitude double, on_ground boolean, time_position timestamp_ntz"
    for number in range(7):
        keys = {f"k{(number * 3 + j) % 11}" for j in range(4)}
        seen |= keys
        batch = spark.createDataFrame([(k, "EMEA", 1.0, None, True, None) for k in keys], schema)
        for _ in range(2):  # every batch runs twice
            summaries.merge_batch(batch, number, root, compact_every=3)
    (row,) = summaries.read_summary(spark, root).collect()
    assert (row.n_rows, row.n_aircraft, row.n_on_ground, row.avg_velocity, row.max_baro_altitude) == (28, len(seen), 28, 1.0, None)
    assert len(list(Path(root, "keys").iterdir())) < 7


def test_many_small_batches_lose_no_counter(spark, folder):
    """More batches than a query's progress keeps."""
    bronze, root = scratch_path(spark, "small-bronze"), scratch_path(spark, "test-counters")
    events = table(spark, folder, "events").where("event_id < 130")
    to_state_vectors(events).repartitionByRange(120, "event_id").write.parquet(bronze)
    built = medallion.Medallion(*[f"{root}/{n}" for n in ("bronze", "silver", "gold", "summary", "expectations")])
    stream = run.file_stream(spark, bronze, files_per_batch=1)
    run.each_batch(stream, lambda b, n: medallion.count_batch(b, n, built), f"{root}/checkpoint")
    vectors = to_state_vectors(events)
    got = medallion.read_expectations(spark, built)
    expected = expectation_metrics(vectors, SILVER_DROP + SILVER_WARN)
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))
    assert medallion.read_silver(spark, built).count() == keep_passing(vectors, SILVER_DROP).count()
