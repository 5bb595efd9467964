"""Live positions: the state of every aircraft, kept by a stateful operator with timers."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from skyweave.sources.telemetry import KEY, ROW_ID, TIME
from skyweave.streaming.run import each_batch, event_time
from skyweave.streaming.tables import stored_table

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def keyed_state(spark: SparkSession):
    """The state store that operators with timers need."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


class LivePosition(StatefulProcessor):
    """Keeps the newest row of a key. Gives a row when it changes, and another when event time has passed it by ``silence``. Times are
    microseconds."""

    def __init__(self, key: str, fields: list[str], schema: T.StructType, ts: str, row_id: str, silence_ms: int):
        self.key, self.fields, self.schema = key, fields, schema
        self.ts, self.row_id, self.silence_ms = ts, row_id, silence_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", self.schema)

    def _out(self, key, values: tuple, status: str) -> Row:
        return Row(**{self.key: key[0], **dict(zip(self.fields, values)), "status": status})

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = self.last.get() if self.last.exists() else None
        place = self.fields.index(self.ts), self.fields.index(self.row_id)
        best = None if held is None else tuple(held)
        changed = False
        for row in rows:
            values = tuple(row[f] for f in self.fields)
            if values[place[0]] is None:
                continue
            if best is None or [values[i] for i in place] > [best[i] for i in place]:
                best, changed = values, True
        if not changed:
            return iter([])
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer[0] if isinstance(timer, tuple) else timer)
        self.last.update(best)
        self.handle.registerTimer(-(-best[place[0]] // 1000) + self.silence_ms)
        return iter([self._out(key, best, "live")])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.last.exists():
            return iter([])
        values = tuple(self.last.get())
        self.last.clear()
        return iter([self._out(key, values, "silent")])

    def close(self) -> None:
        pass


def live_positions(
    stream: DataFrame,
    root: str,
    silence: str = "2 days",
    delay: str = "1 hour",
    key: str = KEY,
    ts: str = TIME,
    row_id: str = ROW_ID,
) -> DataFrame:
    """The last known row of every key with its ``status``, over all the stream has delivered to ``root`` so far: ``live``, or ``silent``
    once the watermark (the latest time less ``delay``) has passed the row by ``silence``.

    The operator's state has one row for each live key; a key that falls silent leaves the state and comes back with its next row.
    Every batch appends what has changed, at most two rows per key; a batch that runs again replaces its rows. A run on the same folder
    goes on where the last one ended, its timers included. Rows behind the watermark and rows without a time change nothing.
    """
    spark = stream.sparkSession
    # State holds times as numbers, which come back as they went, whatever the zone of a worker.
    times = [f.name for f in stream.schema if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))]
    fields = [f for f in stream.columns if f != key]
    held = {f: f"__{f}" if f in times else f for f in fields}
    timed = event_time(stream, ts, delay).withColumns({held[f]: F.unix_micros(F.col(f).cast("timestamp")) for f in times})
    inner = T.StructType([T.StructField(held[f], timed.schema[held[f]].dataType) for f in fields])
    given = T.StructType([timed.schema[key], *inner.fields, T.StructField("status", T.StringType())])
    seconds = spark.sql(f"SELECT CAST(INTERVAL {silence} AS INTERVAL SECOND)").first()[0].total_seconds()
    processor = LivePosition(key, list(held.values()), inner, held[ts], row_id, int(seconds * 1000))
    changes = timed.groupBy(key).transformWithState(processor, given, "Update", "EventTime")
    marked = T.StructType([*given.fields, T.StructField("batch", T.LongType())])

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/changes/batch={batch_id}")

    with keyed_state(spark):
        each_batch(changes, write, f"{root}/checkpoint")
    # Of two rows of one batch the later time counts, and of one time silence, which follows the row it is about.
    order = F.struct("batch", held[ts], (F.col("status") == "silent").alias("silent"))
    rest = [f for f in given.names if f != key]
    newest = stored_table(spark, f"{root}/changes", marked).groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("row"))
    back = [
        (F.timestamp_micros(f"row.{held[f]}") if f in times else F.col(f"row.{f}")).cast(stream.schema[f].dataType).alias(f) for f in fields
    ]
    return newest.select(key, *back, F.col("row.status").alias("status"))
