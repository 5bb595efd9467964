"""Change streams applied as they come: current state and history of every key, late and repeated changes included.

A table is kept in folders by a hash of the key. A batch lays its changes aside; they are folded into the table when they are as large as
it, and when the stream has been read to its end. So each fold doubles the table or is the last, and what is written grows with the
changes and not with the number of batches. A fold reads and rewrites only the folders of the keys it has changes for; what is
stored and what comes are put together by (key, sequence), so it makes no difference how the changes are cut into batches, in
which order they come, or whether a batch or a fold runs twice. Deletes are kept as marks, for a change that comes after one may belong
before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyweave.operators.sequence import TARGET_ROWS, Slices, ordered_scan, plan_slices
from skyweave.streaming.run import each_batch
from skyweave.streaming.tables import stored_table

FOLDERS = 64
"""Folders of a table. Choose so that one holds some hundred MB; fixed once the table has rows."""

_FOLDER, _GONE, _ENDS = "key_range", "__gone", "valid_to"


def key_range(key: str, folders: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(folders)).cast("int")


def _like(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(_GONE, T.BooleanType()), T.StructField(_FOLDER, T.IntegerType())])


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _bytes(spark: SparkSession, path: str) -> int:
    system, place = _place(spark, path)
    return system.getContentSummary(place).getLength() if system.exists(place) else 0


def _waiting(path: str) -> str:
    return f"{path}-waiting"


def _fold(spark: SparkSession, path: str, schema: T.StructType, merge) -> None:
    """Rewrite the folders the waiting changes have keys of: ``merge(stored, fresh)`` gives their new rows."""
    system, place = _place(spark, _waiting(path))
    parts = [str(s.getPath()) for s in system.listStatus(place)] if system.exists(place) else []
    if not parts:
        return
    fresh = spark.read.schema(schema).parquet(*parts)
    touched = sorted(r[0] for r in fresh.select(_FOLDER).distinct().collect())
    if touched:
        stored = stored_table(spark, path, schema).where(F.col(_FOLDER).isin(touched))
        (
            merge(stored, fresh)
            .hint("rebalance", _FOLDER)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(_FOLDER)
            .parquet(path)
        )
    for part in parts:
        system.delete(_place(spark, part)[1], True)


def _apply(stream: DataFrame, path: str, checkpoint: str, schema: T.StructType, marked, merge, folders: int, key: str) -> None:
    """Take in all the stream has: ``marked(batch)`` are the changes of a batch as the table holds them, ``schema`` their columns."""
    spark = stream.sparkSession

    def handle(batch: DataFrame, number: int) -> None:
        # Named after its batch, so a batch that runs again replaces what it left.
        fresh = marked(batch).withColumn(_FOLDER, key_range(key, folders))
        fresh.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{_waiting(path)}/{number}")
        if _bytes(spark, _waiting(path)) >= _bytes(spark, path):
            _fold(spark, path, schema, merge)

    each_batch(stream, handle, checkpoint)
    _fold(spark, path, schema, merge)


def _marked(batch: DataFrame, key: str, sequence: str, is_delete: Column) -> DataFrame:
    known = F.col(key).isNotNull() & F.col(sequence).isNotNull()
    return batch.where(known).withColumn(_GONE, F.coalesce(is_delete, F.lit(False)))


def _one_each(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: repeats are equal, and of different rows with one key the greatest is the one, whatever came first."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("__row")).select(*keys, "__row.*")


def current_state(
    stream: DataFrame, root: str, key: str, sequence: str, is_delete: Column, folders: int = FOLDERS
) -> DataFrame:
    """Type 1: the newest state of every key over all the stream has delivered to ``root``; deleted keys are left out.

    Changes without a key or a sequence number are left out.
    """
    spark, path = stream.sparkSession, f"{root}/current"

    def merge(stored: DataFrame, fresh: DataFrame) -> DataFrame:
        both = stored.unionByName(fresh)
        rest = [c for c in both.columns if c not in (key, _FOLDER)]
        order = F.struct(sequence, F.struct(*[c for c in rest if c != sequence]))
        newest = both.groupBy(key, _FOLDER).agg(F.max_by(F.struct(*rest), order).alias("__row"))
        return newest.select(key, "__row.*", _FOLDER)

    schema = _like(stream.schema)
    _apply(stream, path, f"{root}/checkpoint", schema, lambda batch: _marked(batch, key, sequence, is_delete), merge, folders, key)
    return stored_table(spark, path, schema).where(~F.col(_GONE)).select(*stream.columns)


def _slices(rows: DataFrame, key: str, order: str) -> Slices:
    """Slices for the scan of each key; keys are only cut where one has more rows than a task should take."""
    crowded = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > TARGET_ROWS)
    return plan_slices(rows, order) if crowded.head(1) else Slices()


def state_history(
    stream: DataFrame, root: str, key: str, sequence: str, is_delete: Column, folders: int = FOLDERS
) -> DataFrame:
    """Type 2: every state of every key with its half-open validity, over all the stream has delivered to ``root``.

    A late change ends the interval it falls into and lasts until the next one begins. Ends are stored with the rows and found
    anew only in the folders of the changed keys. A delete ends the state before it. Of different changes with one key
    and number, one counts, the same in any order of delivery.
    """
    spark, path = stream.sparkSession, f"{root}/history"
    names, ends = stream.columns, stream.schema[sequence].dataType

    def merge(stored: DataFrame, fresh: DataFrame) -> DataFrame:
        both = stored.drop(_ENDS).unionByName(fresh.drop(_ENDS))
        slices = _slices(both, key, sequence)
        # One shuffle serves both steps, unless a key is too large for one task.
        dealt = both.repartition(_FOLDER, key) if slices.single else both
        every = _one_each(dealt, [key, sequence, _FOLDER])
        return ordered_scan(every, [_FOLDER, key], sequence, previous={_ENDS: F.col(sequence)}, descending=True, slices=slices)

    def marked(batch: DataFrame) -> DataFrame:
        return _marked(batch, key, sequence, is_delete).withColumn(_ENDS, F.lit(None).cast(ends))

    like = T.StructType([*stream.schema.fields, T.StructField(_GONE, T.BooleanType()), T.StructField(_ENDS, ends)])
    schema = like.add(_FOLDER, T.IntegerType())
    _apply(stream, path, f"{root}/checkpoint", schema, marked, merge, folders, key)
    kept = stored_table(spark, path, schema).where(~F.col(_GONE))
    return kept.select(
        *[F.col(n).alias("valid_from" if n == sequence else n) for n in names],
        F.col(_ENDS),
        F.col(_ENDS).isNull().alias("is_current"),
    )
