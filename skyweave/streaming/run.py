"""Starting streams over stored data and running them to completion."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skyweave.session import scratch_path


def file_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Incremental read of a growing folder of Parquet files, with the schema of what is there.

    By default one batch takes all files waiting. That is the safe choice in front of a watermark:
    a backlog cut into batches is read in file order, and rows of files that come later than their
    event time would count as late. Cap the batches for stateless flows only.
    """
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def event_time(stream: DataFrame, column: str, delay: str | None = None) -> DataFrame:
    """Make a zone-free timestamp usable as event time, optionally with a watermark."""
    timed = stream.withColumn(column, F.col(column).cast("timestamp"))
    return timed.withWatermark(column, delay) if delay else timed


def zone_free(df: DataFrame) -> DataFrame:
    """Turn instants back into zone-free timestamps for comparison with stored tables."""
    return df.withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c, kind in df.dtypes if kind == "timestamp"}
    )


def finish(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def to_table(
    stream: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None
) -> StreamingQuery:
    """Append everything available to a Parquet table, exactly once per input row. Gives the finished query, with its progress."""
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.start()
    finish(query)
    return query


def drain(stream: DataFrame, name: str) -> DataFrame:
    """Run a stream to its end into a fresh table and return the table."""
    spark = stream.sparkSession
    path = scratch_path(spark, name)
    to_table(stream, path, scratch_path(spark, f"{name}-checkpoint"))
    return spark.read.schema(stream.schema).parquet(path)


def each_batch(stream: DataFrame, handle, checkpoint: str) -> None:
    """Call ``handle(batch, batch_id)`` for every micro-batch until the input is used up."""
    finish(
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
