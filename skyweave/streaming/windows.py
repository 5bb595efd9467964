"""Event-time aggregates. Append mode emits a window once the watermark has passed its end."""

from __future__ import annotations

from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyweave.sources.telemetry import KEY, TIME


def tumbling_counts(stream: DataFrame, size: str = "1 day", ts: str = TIME) -> DataFrame:
    """Rows, and rows with a velocity, per window."""
    return (
        stream.groupBy(F.window(ts, size).alias("w"))
        .agg(F.count(F.lit(1)).alias("n_rows"), F.count("velocity").alias("n_velocity"))
        .select(
            F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n_rows", "n_velocity"
        )
    )


def sliding_features(
    stream: DataFrame, size: str = "2 hours", slide: str = "1 hour", key: str = KEY, ts: str = TIME
) -> DataFrame:
    """Per-entity features over overlapping windows."""
    return (
        stream.groupBy(F.window(ts, size, slide).alias("w"), key)
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.max("baro_altitude").alias("max_baro_altitude"),
            F.round(F.avg("velocity"), 6).alias("avg_velocity"),
        )
        .select(
            key,
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "n_rows",
            "max_baro_altitude",
            "avg_velocity",
        )
    )


def flight_sessions(stream: DataFrame, gap: str = "30 minutes", key: str = KEY, ts: str = TIME) -> DataFrame:
    """Sessions of each entity; a session ends one gap after its last row."""
    return (
        stream.groupBy(F.session_window(ts, gap).alias("w"), key)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select(key, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n_rows")
    )


@contextmanager
def local_session_merge(spark: SparkSession):
    """Merge sessions inside each input partition before the shuffle, so a hot key travels as a few
    merged sessions and not as all of its rows."""
    name = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def thinned(stream: DataFrame, row_id: str) -> DataFrame:
    """Without the copies an Arrow batch of an input partition holds of a row: a row replayed very often
    travels as a few copies. Keeps no state; use it before the watermark is set."""

    def first_of_each(batches):
        for batch in batches:
            rows = pa.table({"id": batch.column(row_id), "at": pa.array(range(batch.num_rows))})
            yield batch.take(rows.group_by("id").aggregate([("at", "min")]).column("at_min").combine_chunks())

    return stream.mapInArrow(first_of_each, stream.schema)


def without_repeats(stream: DataFrame, row_id: str) -> DataFrame:
    """Drop rows whose id was seen within the watermark; one stateful step. Put ``thinned`` before it where single
    rows may be replayed very often."""
    return stream.dropDuplicatesWithinWatermark([row_id])
