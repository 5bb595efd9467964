"""Tables kept up to date by a stream.

Each has a folder of its own (``root``), checkpoint included: the next run on the same folder takes only what is new. Every
write is named after its batch, so a batch that runs again after a failure replaces its own output. Nothing about a table is
kept in the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyweave.operators.rules import expectation_metrics, keep_passing
from skyweave.operators.tracks import latest_row
from skyweave.sources.sinks import delete, overwrite
from skyweave.sources.telemetry import KEY, ROW_ID, TIME
from skyweave.streaming.run import each_batch

# Batches after which the winners of single batches are merged.
COMPACT_EVERY = 16


def silver(bronze: DataFrame, drop_rules) -> DataFrame:
    """Rows of a bronze stream that pass every hard rule."""
    return keep_passing(bronze, drop_rules)


def _with_batch(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("batch", T.LongType())])


def stored_table(spark: SparkSession, path: str, like) -> DataFrame:
    """The table in a folder, empty where nothing has been written yet."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(place) or all(s.getPath().getName().startswith(("_", ".")) for s in system.listStatus(place)):
        return spark.createDataFrame([], like)
    return spark.read.schema(like).parquet(path)


def latest_positions(
    stream: DataFrame, root: str, key: str = KEY, ts: str = TIME, row_id: str = ROW_ID, compact_every: int = COMPACT_EVERY
) -> DataFrame:
    """Most recent row per key, over everything the stream has delivered to ``root`` so far.

    Each batch appends its own winners, one row for each key in it. Every ``compact_every`` batches the winners
    of the batches before are merged into one base table. Reading takes the newest of base and winners.
    """
    spark = stream.sparkSession
    like = stream.schema
    marked = _with_batch(like)
    winners, base = f"{root}/winners", f"{root}/base"

    def merge(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        latest_row(batch, key, ts, row_id).write.mode("overwrite").parquet(f"{winners}/batch={batch_id}")
        if (batch_id + 1) % compact_every == 0:
            every = stored_table(session, winners, marked)
            old = every.where(F.col("batch") < batch_id)
            both = stored_table(session, base, like).unionByName(old.drop("batch"))
            overwrite(latest_row(both, key, ts, row_id), base)
            # What the base holds now is removed; a repeated run finds the winners either there or here.
            for found in [r.batch for r in old.select("batch").distinct().collect()]:
                delete(session, f"{winners}/batch={found}")

    each_batch(stream, merge, f"{root}/checkpoint")
    return latest_row(stored_table(spark, base, like).unionByName(stored_table(spark, winners, marked).drop("batch")), key, ts, row_id)


def expectation_counters(stream: DataFrame, rules, root: str) -> DataFrame:
    """Rows passed and failed per rule over the whole stream, from one counter row per rule and batch."""
    spark = stream.sparkSession

    def count(batch: DataFrame, batch_id: int) -> None:
        expectation_metrics(batch, rules).write.mode("overwrite").parquet(f"{root}/counters/batch={batch_id}")

    each_batch(stream, count, f"{root}/checkpoint")
    return (
        stored_table(spark, f"{root}/counters", "rule string, passed bigint, failed bigint, batch bigint")
        .groupBy("rule")
        .agg(F.sum("passed").alias("passed"), F.sum("failed").alias("failed"))
    )


def append_batches(stream: DataFrame, prepare, root: str) -> DataFrame:
    """Append ``prepare(batch)`` to a table partitioned by batch; replays overwrite their own batch."""
    spark = stream.sparkSession
    like = prepare(spark.createDataFrame([], stream.schema)).schema

    def write(batch: DataFrame, batch_id: int) -> None:
        prepare(batch).write.mode("overwrite").parquet(f"{root}/table/batch={batch_id}")

    each_batch(stream, write, f"{root}/checkpoint")
    return stored_table(spark, f"{root}/table", _with_batch(like)).drop("batch")
