"""The regional summary as a table of mergeable parts.

Each batch adds its own counts, sums and extremes per region, and the keys it has seen there. The summary of a region comes from these
parts, not from the rows, and only the regions of a batch are written again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyweave.sources.sinks import delete, overwrite
from skyweave.streaming.tables import stored_table

COMPACT_EVERY = 16
"""Batches after which the key sets of single batches become one."""

_PARTS = """region string, n_rows bigint, velocity_sum double, velocity_n bigint, baro_sum double, baro_n bigint,
    max_baro_altitude double, n_on_ground bigint, first_seen timestamp_ntz, last_seen timestamp_ntz, batch bigint"""
_KEYS = "icao24 string, region string, batch bigint"
_SUMMARY = """n_rows bigint, n_aircraft bigint, avg_velocity double, avg_baro_altitude double, max_baro_altitude double,
    n_on_ground bigint, first_seen timestamp_ntz, last_seen timestamp_ntz, region string"""


def parts_of(routed: DataFrame) -> DataFrame:
    """The batch's part of the summary, one row per region; reduced before the shuffle."""
    return routed.groupBy("region").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("velocity").alias("velocity_sum"),
        F.count("velocity").alias("velocity_n"),
        F.sum("baro_altitude").alias("baro_sum"),
        F.count("baro_altitude").alias("baro_n"),
        F.max("baro_altitude").alias("max_baro_altitude"),
        F.count_if(F.col("on_ground")).alias("n_on_ground"),
        F.min("time_position").alias("first_seen"),
        F.max("time_position").alias("last_seen"),
    )


def merge_batch(routed: DataFrame, batch_id: int, root: str, compact_every: int = COMPACT_EVERY) -> list[str]:
    """Add a batch and write the summaries of its regions again; returns these regions. A batch that runs again replaces its parts."""
    spark = routed.sparkSession
    parts_of(routed).write.mode("overwrite").parquet(f"{root}/parts/batch={batch_id}")
    keys = routed.select("icao24", "region").where("icao24 is not null").distinct()
    keys.write.mode("overwrite").parquet(f"{root}/keys/batch={batch_id}")
    if (batch_id + 1) % compact_every == 0:
        _compact(spark, root, batch_id)
    parts = stored_table(spark, f"{root}/parts", _PARTS)
    touched = sorted(r.region for r in parts.where(F.col("batch") == batch_id).select("region").collect())
    if touched:
        summary_of(spark, root, touched).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "region"
        ).parquet(f"{root}/table")
    return touched


def _known_keys(spark: SparkSession, root: str) -> DataFrame:
    base = stored_table(spark, f"{root}/all-keys", "icao24 string, region string")
    return base.unionByName(stored_table(spark, f"{root}/keys", _KEYS).drop("batch"))


def _compact(spark: SparkSession, root: str, batch_id: int) -> None:
    """One set of keys from those of the batches before; a repeated run finds them either here or there."""
    old = stored_table(spark, f"{root}/keys", _KEYS).where(F.col("batch") < batch_id)
    numbers = [r.batch for r in old.select("batch").distinct().collect()]
    base = stored_table(spark, f"{root}/all-keys", "icao24 string, region string")
    overwrite(base.unionByName(old.drop("batch")).distinct(), f"{root}/all-keys")
    for number in numbers:
        delete(spark, f"{root}/keys/batch={number}")


def summary_of(spark: SparkSession, root: str, regions: list[str]) -> DataFrame:
    """The summary of some regions from their parts."""
    mine = F.col("region").isin(regions)
    total = (
        stored_table(spark, f"{root}/parts", _PARTS)
        .where(mine)
        .groupBy("region")
        .agg(
            F.sum("n_rows").alias("n_rows"),
            F.round(F.sum("velocity_sum") / F.sum("velocity_n"), 6).alias("avg_velocity"),
            F.round(F.sum("baro_sum") / F.sum("baro_n"), 6).alias("avg_baro_altitude"),
            F.max("max_baro_altitude").alias("max_baro_altitude"),
            F.sum("n_on_ground").alias("n_on_ground"),
            F.min("first_seen").alias("first_seen"),
            F.max("last_seen").alias("last_seen"),
        )
    )
    aircraft = _known_keys(spark, root).where(mine).groupBy("region").agg(F.count_distinct("icao24").alias("n_aircraft"))
    return total.join(aircraft, "region", "left").withColumn("n_aircraft", F.coalesce("n_aircraft", F.lit(0)))


def read_summary(spark: SparkSession, root: str) -> DataFrame:
    return stored_table(spark, f"{root}/table", _SUMMARY)
