"""Tables an operator writes on its way, in the shared folder the session names."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyweave.session import scratch_root

_FREES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Workspace:
    """A folder of its own under ``spark.checkpoint.dir`` for one run of one operator.

    Every cut of a lineage is a Parquet table here, which all executors can read and which outlives any of them.
    ``drop`` removes a table as soon as no plan needs it; what a returned DataFrame still reads
    stays until the caller calls ``close``, or else until the driver's Python ends.
    With ``frees`` the shuffle files of a table go as soon as it is written, and not when the driver's JVM next collects its garbage.
    """

    def __init__(self, spark: SparkSession, name: str, frees: bool = False):
        self.spark = spark
        self.frees = frees
        self.path = f"{scratch_root(spark)}/skyweave-llm/{name}-{uuid.uuid4().hex}"
        atexit.register(self._end)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.path}/{name}"
        before = self.spark.conf.get(_FREES, None)
        if self.frees:
            self.spark.conf.set(_FREES, "true")
        try:
            df.write.option("compression", "zstd").parquet(path)
        finally:
            if self.frees:
                self.spark.conf.unset(_FREES) if before is None else self.spark.conf.set(_FREES, before)
        return self.spark.read.schema(df.schema).parquet(path)

    def folder(self, name: str) -> str:
        return f"{self.path}/{name}"

    def drop(self, *names: str) -> None:
        for name in names:
            self._delete(f"{self.path}/{name}")

    def close(self) -> None:
        atexit.unregister(self._end)
        self._delete(self.path)

    def _end(self) -> None:
        # A session stopped before has no way to the files any more.
        if self.spark._jsc.sc().isStopped() is False:
            self._delete(self.path)

    def _delete(self, path: str) -> None:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)


def numbered(df: DataFrame, name: str = "row_id") -> DataFrame:
    """With a number for each row; write the result before using the number more than once."""
    return df.withColumn(name, F.monotonically_increasing_id())


def null_safe(left: DataFrame, right: DataFrame, names: list[str]):
    """Join condition that lets null meet null."""
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition
