"""Streams over several small deliveries: the outcome must equal the batch result."""

from pathlib import Path

from pyspark.sql import functions as F

from skyweave.operators.rules import SILVER_DROP, SILVER_WARN, expectation_metrics, keep_passing
from skyweave.operators.tracks import latest_row
from skyweave.plans import medallion
from skyweave.session import scratch_path
from skyweave.sources.telemetry import state_vectors, table, to_state_vectors
from skyweave.streaming import run, tables, windows


def delivered(spark, folder, files=4):
    """The events as several deliveries, in time order."""
    path = scratch_path(spark, "test-feed")
    events = table(spark, folder, "events")
    bounds = [None, *(events.approxQuantile("event_id", [i / files for i in range(1, files)], 0.0)), None]
    for low, high in zip(bounds, bounds[1:]):
        part = events if low is None else events.where(F.col("event_id") >= low)
        part = part if high is None else part.where(F.col("event_id") < high)
        part.coalesce(1).write.mode("append").parquet(path)
    return path


def same(a, b):
    assert a.columns == b.columns
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_latest_over_many_batches(spark, folder):
    stream = run.file_stream(spark, delivered(spark, folder), files_per_batch=1)
    columns = ["icao24", "event_id", "time_position", "velocity"]
    got = tables.latest_positions(to_state_vectors(stream).select(*columns), scratch_path(spark, "t"), compact_every=3)
    same(got, latest_row(state_vectors(spark, folder).select(*columns)))


def test_tables_resume(spark, folder):
    """New files, no new files, and a batch that runs twice."""
    path, roots = scratch_path(spark, "test-feed"), {n: scratch_path(spark, n) for n in ("latest", "count", "append")}
    events, columns = table(spark, folder, "events"), ["icao24", "event_id", "time_position", "velocity"]
    vectors = state_vectors(spark, folder)

    def build():
        stream = lambda: to_state_vectors(run.file_stream(spark, path, files_per_batch=1))
        return (
            tables.latest_positions(stream().select(*columns), roots["latest"], compact_every=2),
            tables.expectation_counters(stream(), SILVER_DROP, roots["count"]),
            tables.append_batches(stream(), lambda b: keep_passing(b, SILVER_DROP).select("event_id"), roots["append"]),
        )

    def check(upto):
        seen = vectors.where(F.col("event_id") < upto)
        latest, counters, appended = build()
        same(latest, latest_row(seen.select(*columns)))
        same(counters, expectation_metrics(seen, SILVER_DROP))
        same(appended, keep_passing(seen, SILVER_DROP).select("event_id"))

    for low, high in ((0, 300), (300, 600), (600, 600), (600, 2000)):
        if low < high:
            part = events.where((F.col("event_id") >= low) & (F.col("event_id") < high))
            part.repartition(2).write.mode("append").parquet(path)
        check(high)
    # The last batch is taken back as if its commit had been lost.
    for root in roots.values():
        commits = Path(root, "checkpoint", "commits")
        last = max(int(p.name) for p in commits.iterdir() if p.name.isdigit())
        for p in (commits / str(last), commits / f".{last}.crc"):
            p.unlink(missing_ok=True)
    check(2000)


def test_counters_over_many_batches(spark, folder):
    stream = run.file_stream(spark, delivered(spark, folder), files_per_batch=1)
    got = tables.expectation_counters(to_state_vectors(stream), SILVER_DROP, scratch_path(spark, "t"))
    same(got, expectation_metrics(state_vectors(spark, folder), SILVER_DROP))


def test_appended_batches(spark, folder):
    stream = run.file_stream(spark, delivered(spark, folder), files_per_batch=2)
    prepare = lambda b: keep_passing(b, SILVER_DROP).select("event_id")
    got = tables.append_batches(to_state_vectors(stream), prepare, scratch_path(spark, "t"))
    same(got, keep_passing(state_vectors(spark, folder), SILVER_DROP).select("event_id"))


def test_copies_across_batches_are_dropped(spark, folder):
    path = delivered(spark, folder, 3)
    # A burst of copies of one row, and a second copy of everything, in the same delivery.
    events = spark.read.parquet(path)
    burst = events.where("event_id = 10").crossJoin(spark.range(500)).drop("id")
    events.unionByName(events).unionByName(burst).repartition(6).write.mode("append").parquet(path)
    stream = windows.thinned(run.file_stream(spark, path).select("event_id", "ts"), "event_id")
    got = run.drain(windows.without_repeats(run.event_time(stream, "ts", "60 days"), "event_id"), "once")
    assert got.count() == events.select("event_id").distinct().count() == 1000


def test_late_rows_are_left_out_only_beyond_the_watermark(spark, folder):
    stream = run.event_time(run.file_stream(spark, delivered(spark, folder), 1), "ts", "1 hour")
    timed = stream.select(F.col("ts").alias("time_position"), F.col("value").alias("velocity"))
    got = run.drain(windows.tumbling_counts(timed), "closed")
    events = table(spark, folder, "events")
    limit = events.agg(F.max("ts") - F.expr("INTERVAL 1 HOUR")).first()[0]
    closed = events.groupBy(F.window("ts", "1 day").alias("w")).count().where(F.col("w.end") <= F.lit(limit))
    assert got.agg(F.sum("n_rows")).first()[0] == closed.agg(F.sum("count")).first()[0]


def test_second_run_reads_only_new_files(spark, folder):
    source, root = scratch_path(spark, "test-source"), scratch_path(spark, "test-medallion")
    events = table(spark, folder, "events")
    early = F.col("event_id") < 400
    events.where(early).write.parquet(source)
    medallion.build(spark, source, root=root)
    events.where(~early).write.mode("append").parquet(source)
    built = medallion.build(spark, source, root=root)
    bronze = spark.read.parquet(built.bronze)
    assert bronze.count() == bronze.select("event_id").distinct().count() == events.count()
    gold = medallion.read_gold(spark, built)
    counters = medallion.read_expectations(spark, built)
    same(counters, expectation_metrics(state_vectors(spark, folder), SILVER_DROP + SILVER_WARN))
    summary = {r.region: r.n_rows for r in medallion.read_summary(spark, built).collect()}
    assert summary == {r.region: r["count"] for r in gold.groupBy("region").count().collect()}
    assert medallion.regional_gold(spark, built, "EMEA").count() == summary["EMEA"]
