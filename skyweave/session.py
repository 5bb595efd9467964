"""Session settings and the shared scratch area."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_local_root: str | None = None
_made: set[str] = set()
_once: dict[tuple, str] = {}

# Bytes of a shuffle partition before AQE merges small ones.
PARTITION_BYTES = 256 << 20

# Most rows a side may have to be broadcast.
BROADCAST_ROWS = 10_000


def build_session(
    master: str | None = None,
    partitions: int | None = None,
    app: str = "skyweave",
    driver_memory: str | None = None,
    shared: str | None = None,
    input_bytes: int | None = None,
) -> SparkSession:
    """A session with the settings the library is tuned for.

    On a cluster leave ``master`` and ``partitions`` unset and name the folder all executors share in ``shared``, unless
    ``spark.checkpoint.dir`` is set already. AQE only ever merges shuffle partitions, so there must be enough of them to begin
    with: ``input_bytes``, the size of the largest input of a shuffle, gives one for each PARTITION_BYTES, 4000 without it.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
        .config("spark.sql.files.maxPartitionBytes", "256m")
        .config("spark.sql.parquet.filterPushdown", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    else:
        first = max(4000, -(-(input_bytes or 0) // PARTITION_BYTES))
        builder = builder.config("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(first))
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``; for local masters without one, as in tests, a temporary folder that
    goes with the process."""
    global _local_root
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="skyweave-")
        atexit.register(shutil.rmtree, _local_root, ignore_errors=True)
    return _local_root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared scratch root; never reused, so concurrent runs cannot clash."""
    path = f"{scratch_root(spark)}/skyweave/{name}-{uuid.uuid4().hex}"
    _made.add(path)
    return path


def made_once(spark: SparkSession, name: str, key: tuple, make: Callable[[str], None]) -> str:
    """A folder under the scratch root that ``make`` fills at the first call with this key in an application, and later calls find
    again; after ``clean_scratch`` it is made anew."""
    whole = (spark.sparkContext.applicationId, name, *key)
    path = _once.get(whole)
    if path is None or path not in _made:
        path = scratch_path(spark, name)
        make(path)
        _once[whole] = path
    return path


def clean_scratch(spark: SparkSession) -> int:
    """Delete what this process has put under the shared scratch root; gives the number of folders.

    For long sessions: call it once no DataFrame that was returned is needed any more.
    """
    count = len(_made)
    for path in list(_made):
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        _made.discard(path)
    return count


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage at a point several downstream branches start from. The copy outlives
    executors, so a lost executor costs a re-read and not a recomputation of the whole plan.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_side(df: DataFrame, name: str) -> tuple[DataFrame, list | None]:
    """The small side of a join, computed once, with its rows.

    Up to ``BROADCAST_ROWS`` rows become a local table marked for broadcast. Anything larger is written to the
    shared folder, left to an ordinary shuffle join, and has no rows here.
    """
    spark = df.sparkSession
    rows = df.limit(BROADCAST_ROWS + 1).collect()
    if len(rows) <= BROADCAST_ROWS:
        return F.broadcast(spark.createDataFrame(rows, df.schema)), rows
    return materialise(df, name), None


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give iterative jobs a place for their checkpoints where the cluster has not named one."""
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        spark.sparkContext.setCheckpointDir(f"{scratch_root(spark)}/checkpoints")
