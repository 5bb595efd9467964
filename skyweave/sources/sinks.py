"""Writes. Every function returns what a reader sees afterwards."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _gathered(df: DataFrame, partition_by: list[str] | None) -> DataFrame:
    """Bring the rows of a folder together before a partitioned write.

    Without it every task would write a small file into every folder. Rebalancing lets AQE split a
    folder that holds far more rows than the others.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df


def _files(spark: SparkSession, path: str):
    """Hadoop's view of a path: the path itself and the file system it is on."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder, if there is one."""
    place, system = _files(spark, path)
    system.delete(place, True)


def switch(spark: SparkSession, fresh: str, path: str) -> None:
    """Put a finished folder in the place of another one.

    The old folder is set aside first and put back should the renaming fail, so a table is missing only between two renames.
    """
    new, system = _files(spark, fresh)
    old, _ = _files(spark, path)
    aside, _ = _files(spark, f"{path.rstrip('/')}.old-{uuid.uuid4().hex}")
    had = system.exists(old)
    if had and not system.rename(old, aside):
        raise OSError(f"cannot set {path} aside")
    system.mkdirs(old.getParent())
    if not system.rename(new, old):
        if had:
            system.rename(aside, old)
        raise OSError(f"cannot move {fresh} to {path}")
    if had:
        system.delete(aside, True)


def overwrite(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Replace a table, schema included. The new one is written beside the old one, which stays if the job fails; so a table
    may also be replaced by something read from it."""
    spark = df.sparkSession
    fresh = f"{path.rstrip('/')}.new-{uuid.uuid4().hex}"
    writer = _gathered(df, partition_by).write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.parquet(fresh)
    except Exception:
        delete(spark, fresh)
        raise
    switch(spark, fresh, path)
    return spark.read.parquet(path)


def check_key(df: DataFrame, key: list[str]) -> DataFrame:
    """Fail unless the key is non-null and unique; the check is one aggregate with one row back."""
    groups = df.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"))
    missing = F.lit(False)
    for column in key:
        missing = missing | F.col(column).isNull()
    found = groups.agg(
        F.count_if(F.col("__n") > 1).alias("repeated"), F.count_if(missing).alias("missing")
    ).first()
    if found.repeated or found.missing:
        raise ValueError(f"key {key}: {found.repeated} repeated and {found.missing} missing values")
    return df


def keyed_table(df: DataFrame, path: str, key: list[str]) -> DataFrame:
    """Create or replace a table with a primary key. The written copy is what gets checked."""
    written = overwrite(df, path)
    return check_key(written, key)


def publish_snapshot(df: DataFrame, path: str, key: list[str]) -> DataFrame:
    """Publish a keyed table as a snapshot; publishing again replaces it."""
    check_key(df, key)
    return overwrite(df, path)


def with_record_id(df: DataFrame, row_key: list[str]) -> DataFrame:
    """Add ``id``, a hash of the key as a JSON object with nulls kept: different keys have different ids, a retry the same."""
    key = F.struct(*[F.col(c).cast("string").alias(c) for c in row_key])
    return df.withColumn("id", F.sha2(F.to_json(key, {"ignoreNullFields": "false"}), 256))


def append_log(df: DataFrame, path: str, row_key: list[str], day: str | None = None) -> DataFrame:
    """Append records with an id derived from their key; records whose id is there already are left out.

    So appending again adds nothing. Records that share a key within ``df`` are one record. With ``day``, a date column that
    follows from the key, the log is partitioned by it and only the stored ids of the days that come are read, whatever the
    length of the log.
    """
    spark = df.sparkSession
    identified = with_record_id(df, row_key).dropDuplicates(["id"])
    place, system = _files(spark, path)
    if system.exists(place):
        stored = spark.read.parquet(path)
        if day:
            days = [r[0] for r in df.select(day).distinct().collect()]
            known = F.col(day).isin([d for d in days if d is not None])
            stored = stored.where(known | F.col(day).isNull() if None in days else known)
        identified = identified.join(stored.select("id"), "id", "left_anti")
    writer = _gathered(identified, [day] if day else None).write.mode("append")
    (writer.partitionBy(day) if day else writer).parquet(path)
    return spark.read.parquet(path)


def export_csv(df: DataFrame, path: str) -> str:
    """Write a result as CSV files with a header; the padding of fixed-width text is kept."""
    df.write.mode("overwrite").options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)
    return path


def replace_range(df: DataFrame, path: str, partition: str, start: date, end: date) -> DataFrame:
    """Refresh the dates [start, end) of a date-partitioned table and leave the others as they are.

    A dynamic overwrite replaces the days that come with new rows; stored days of the range without any are
    removed after it, folder by folder, at most one for each day of the range.
    """
    spark = df.sparkSession
    column = F.col(partition)
    in_range = (column >= F.lit(start)) & (column < F.lit(end))
    before = spark.read.parquet(path)
    schema = before.schema
    stored = before.where(in_range).select(partition).distinct()
    inside = df.where(in_range)
    emptied = [r[0] for r in stored.join(inside.select(partition).distinct(), partition, "left_anti").collect()]
    _gathered(inside, [partition]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        partition
    ).parquet(path)
    for day in emptied:
        delete(spark, f"{path}/{partition}={day.isoformat()}")
    return spark.read.schema(schema).parquet(path)

