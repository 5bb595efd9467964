"""Bronze to silver to regional gold to summary."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyweave.functions.text import minute_of_day
from skyweave.operators.regions import BANDS, route
from skyweave.operators.rules import SILVER_DROP, SILVER_WARN, flag_failures, keep_passing, observe_expectations
from skyweave.session import scratch_path
from skyweave.sources.telemetry import TIME, to_state_vectors
from skyweave.streaming import summaries
from skyweave.streaming.run import each_batch, file_stream, to_table
from skyweave.streaming.tables import stored_table

# The columns of an event that state vectors are made of.
_EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"


def time_range(start: str, end: str, ts: str = TIME) -> Column:
    """Half-open range of instants; compares the stored column itself so the filter can be pushed."""
    return (F.col(ts) >= F.lit(start).cast("timestamp_ntz")) & (F.col(ts) < F.lit(end).cast("timestamp_ntz"))


def time_of_day(start_minute: int, end_minute: int, ts: str = TIME) -> Column:
    """Half-open range of minutes of the day, on any date."""
    minute = minute_of_day(F.col(ts))
    return (minute >= start_minute) & (minute < end_minute)


@dataclass(frozen=True)
class Medallion:
    """Where the tables of one run are."""

    bronze: str
    silver: str
    gold: str
    summary: str
    expectations: str


def build(
    spark: SparkSession,
    source: str,
    *,
    scope: Column | None = None,
    mode: str = "overlap",
    root: str | None = None,
) -> Medallion:
    """Run the whole flow over an events table.

    Bronze and silver are streams with their own checkpoints: a second run on the same root only
    processes new files. Each batch of silver adds its rows to gold, in folders by region so that a regional reader touches only
    those, its counters to the expectations, and its parts to the summary, where only the regions it has rows of are written
    again. Everything a batch writes is named after it and replaced if it runs again, so nothing is lost or counted
    twice after a crash, and nothing is kept in the driver.
    """
    root = root or scratch_path(spark, "medallion")
    tables = Medallion(*[f"{root}/{name}" for name in ("bronze", "silver", "gold", "summary", "expectations")])

    raw = to_state_vectors(file_stream(spark, source))
    to_table(raw if scope is None else raw.where(scope), tables.bronze, f"{root}/checkpoints/bronze")
    bronze = spark.readStream.schema(raw.schema).parquet(tables.bronze)
    each_batch(bronze, lambda batch, number: _take_batch(batch, number, tables, mode), f"{root}/checkpoints/silver")
    return tables


def count_batch(bronze: DataFrame, number: int, tables: Medallion) -> DataFrame:
    """Write silver and the counters of one batch; the counters come with the write, in one pass."""
    spark = bronze.sparkSession
    counted = Observation(f"expectations-{uuid.uuid4().hex}")
    seen = observe_expectations(bronze, counted, SILVER_DROP + SILVER_WARN)
    cleaned = flag_failures(keep_passing(seen, SILVER_DROP), SILVER_WARN)
    path = f"{tables.silver}/batch={number}"
    cleaned.write.mode("overwrite").parquet(path)
    metrics = counted.get
    rows = [(r.name, metrics[r.name], metrics["rows"] - metrics[r.name]) for r in SILVER_DROP + SILVER_WARN]
    counters = spark.createDataFrame(rows, "rule string, passed bigint, failed bigint").coalesce(1)
    counters.write.mode("overwrite").parquet(f"{tables.expectations}/batch={number}")
    return spark.read.schema(cleaned.schema).parquet(path)


def _take_batch(bronze: DataFrame, number: int, tables: Medallion, mode: str) -> None:
    """Silver, counters, gold and summary of one batch."""
    routed = route(count_batch(bronze, number, tables), mode)
    path = f"{tables.gold}/batch={number}"
    writer = routed.hint("rebalance", "region").write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy("region").parquet(path)
    stored = routed.sparkSession.read.schema(routed.schema).parquet(path)
    summaries.merge_batch(stored, number, tables.summary)


def read_expectations(spark: SparkSession, tables: Medallion) -> DataFrame:
    """Rows of bronze that passed and failed each expectation, over all runs."""
    stored = spark.read.schema("rule string, passed bigint, failed bigint, batch bigint").parquet(tables.expectations)
    return stored.groupBy("rule").agg(F.sum("passed").alias("passed"), F.sum("failed").alias("failed"))


def read_silver(spark: SparkSession, tables: Medallion) -> DataFrame:
    return _all_batches(spark, tables.silver, [])


def read_gold(spark: SparkSession, tables: Medallion) -> DataFrame:
    """All regional gold tables with their region."""
    return _all_batches(spark, tables.gold, [T.StructField("region", T.StringType())])


def _all_batches(spark: SparkSession, path: str, more: list[T.StructField]) -> DataFrame:
    """The rows of all batches. The schema is that of silver, so a batch without rows needs no file."""
    empty = to_state_vectors(spark.createDataFrame([], _EVENTS))
    silver = flag_failures(empty, SILVER_WARN).schema
    like = T.StructType([*silver.fields, *more, T.StructField("batch", T.LongType())])
    return stored_table(spark, path, like).drop("batch")


def regional_gold(spark: SparkSession, tables: Medallion, region: str) -> DataFrame:
    """One region's gold table; only its folders are read."""
    if region not in BANDS:
        raise ValueError(f"unknown region: {region}")
    return read_gold(spark, tables).where(F.col("region") == region)


def read_summary(spark: SparkSession, tables: Medallion) -> DataFrame:
    return summaries.read_summary(spark, tables.summary)
