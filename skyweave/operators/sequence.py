"""Ordered per-key computation that stays balanced when one key holds much of the data.

A window partitioned by the key alone puts a hot key into one task. Here each key is also cut into
slices along the ordering axis. The cut points come from counts over the whole input, so no
(key, slice) group can exceed about ``TARGET_ROWS`` rows, whatever the distribution of keys.
What a slice needs from earlier ones (the last row, running totals) is computed from one summary
row per (key, slice) and enters the slice as an extra *carry row* that sorts first. Ordinary window
functions then read it like any other row, and the big data is shuffled once.

When a single instant alone is larger than a slice (a burst of copies, say), rows of such instants are
cut a second time along the tie-break column.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

TARGET_ROWS = 4_000_000
# Parts a range of the axis is divided into at each look.
_PARTS = 64
# Most numbers that are sent to the JVM one by one; longer lists travel packed to Arrow functions.
_LISTED = 256

_CARRY, _SLICE, _AXIS, _TIE = "__carry", "__slice", "__axis", "__tie"
_INF = float("inf")
_LARGEST = sys.float_info.max


@dataclass(frozen=True)
class Slices:
    """Cut points along the axis, instants that need a second cut, and cut points for those."""

    cuts: tuple[float, ...] = ()
    heavy: tuple[float, ...] = ()
    tie_cuts: tuple[float, ...] = ()

    @property
    def single(self) -> bool:
        return not self.cuts and not self.heavy


def _axis(df: DataFrame, column: str) -> Column:
    """Monotone numeric image of an ordering column; nulls sort first and NaN last, as in a window."""
    kind = df.schema[column].dataType
    value = F.col(column)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        value = F.unix_micros(value.cast("timestamp"))
    elif isinstance(kind, T.DateType):
        value = F.unix_date(value)
    elif not isinstance(kind, T.NumericType):
        raise TypeError(f"cannot order by {column}: {kind.simpleString()} is neither a number nor a date nor a timestamp")
    value = value.cast("double")
    return F.when(value.isNull(), F.lit(-_INF)).when(F.isnan(value), F.lit(_INF)).otherwise(value)


def _cut_points(df: DataFrame, column: str, exact: str, target_rows: int) -> tuple[list[float], list[float]]:
    """Cut points that leave at most about ``target_rows`` rows between them, and values that hold more by themselves.

    Counts per part of the axis are one hash aggregate, reduced on the map side. Parts with too many rows are divided
    again in the next look until they fit or hold one value of ``exact``. The driver gets a few numbers for each slice.
    """
    finite = df.where((F.col(column) > -_INF) & (F.col(column) < _INF))
    ends = finite.agg(F.min(column).alias("low"), F.max(column).alias("high")).first()
    if ends.low is None:
        return [], []
    splits = _divided(ends.low, ends.high)
    while True:
        parts = (
            _bucketed(finite, column, tuple(splits), "__part")
            .groupBy("__part")
            .agg(
                F.count(F.lit(1)).alias("n"),
                F.min(column).alias("low"),
                F.max(column).alias("high"),
                (F.min(exact) == F.max(exact)).alias("one"),
            )
            .orderBy("__part")
            .collect()
        )
        finer = {
            x
            for p in parts
            if p.n > target_rows and p.low < p.high
            for x in _divided(p.low, p.high, min(_PARTS, 4 + 4 * (p.n // target_rows)))
        }
        if finer <= set(splits):
            break
        splits = sorted({*splits, *finer, *(p.low for p in parts if p.n > target_rows)})
    cuts, heavy, held = [], [], None
    for p in parts:
        if held is None or held + p.n > target_rows:
            cuts.append(p.low)
            held = 0
        held += p.n
        if p.n > target_rows and p.one:
            heavy.append(p.low)
    return cuts, heavy


def _divided(low: float, high: float, parts: int = _PARTS) -> list[float]:
    """Points that divide a range evenly, its upper end included, as far as numbers lie between."""
    points = {low + (high - low) * (i / parts) for i in range(1, parts + 1)}
    return sorted(x for x in points | {high} if low < x <= high)


def plan_slices(df: DataFrame, order: str, tie: str | None = None, target_rows: int | None = None) -> Slices:
    """Choose the cut points for ``df``; runs jobs on it.

    Small inputs cost one count. Beyond ``target_rows`` (``TARGET_ROWS`` by default) a few aggregates over the ordering column
    follow. The number of slices is rows / ``target_rows``, without a limit. To plan once for several
    scans, or to keep jobs out of a plan, pass the result as ``slices``.
    """
    target_rows = target_rows or TARGET_ROWS
    axis = df.select(
        F.col(order).alias("__order"),
        _axis(df, order).alias(_AXIS),
        *([F.col(tie).alias("__by"), _axis(df, tie).alias(_TIE)] if tie else []),
    )
    size = axis.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(_AXIS) == -_INF).alias("unplaced")).first()
    if size.rows <= target_rows:
        return Slices()
    cuts, heavy = _cut_points(axis, _AXIS, "__order", target_rows)
    if size.unplaced > target_rows:
        heavy.append(-_INF)
    if not tie or not heavy:
        return Slices(tuple(cuts))
    heavy.sort()
    crowd = axis.where(_is_one_of(_AXIS, tuple(heavy)))
    return Slices(tuple(cuts), tuple(heavy), tuple(_cut_points(crowd, _TIE, "__by", target_rows)[0]))


def _bucketed(df: DataFrame, column: str, cuts: tuple[float, ...], out: str) -> DataFrame:
    inner = [c for c in cuts if -_INF < c < _INF]
    if not inner:
        return df.withColumn(out, F.lit(0.0))
    if len(inner) > _LISTED:
        points = np.array(inner)

        @F.pandas_udf("double")
        def place(values: pd.Series) -> pd.Series:
            return pd.Series(np.searchsorted(points, values.to_numpy(), side="right").astype(np.float64))

        return df.withColumn(out, place(column))
    return Bucketizer(splits=[-_INF, *inner, _INF], inputCol=column, outputCol=out).transform(df)


def _is_one_of(column: str, values: tuple[float, ...]) -> Column:
    """Whether a column without nulls has one of the values, which are in order."""
    if len(values) <= _LISTED:
        return F.col(column).isin(list(values))
    points = np.array(values)

    @F.pandas_udf("boolean")
    def found(given: pd.Series) -> pd.Series:
        at = np.minimum(np.searchsorted(points, given.to_numpy()), len(points) - 1)
        return pd.Series(points[at] == given.to_numpy())

    return found(column)


def _with_slice(df: DataFrame, order: str, tie: str | None, slices: Slices) -> DataFrame:
    """Add the slice number; it grows with the (order, tie) position of a row."""
    out = df.withColumn(_AXIS, _axis(df, order))
    out = _bucketed(out, _AXIS, slices.cuts, "__s1")
    if not slices.heavy:
        return out.withColumn(_SLICE, F.struct(F.col("__s1").cast("int").alias("a"))).drop(_AXIS, "__s1")
    # Within a cut of the axis, a heavy instant is always the first one (cuts are closed on the
    # left), so "rest of the cut" must come after all of its pieces.
    out = _bucketed(out.withColumn(_TIE, _axis(df, tie)), _TIE, slices.tie_cuts, "__s2")
    piece = F.when(_is_one_of(_AXIS, slices.heavy), F.col("__s2").cast("int")).otherwise(
        F.lit(len(slices.tie_cuts) + 1)
    )
    return out.withColumn(_SLICE, F.struct(F.col("__s1").cast("int").alias("a"), piece.alias("b"))).drop(
        _AXIS, _TIE, "__s1", "__s2"
    )


def ordered_scan(
    df: DataFrame,
    keys: list[str],
    order: str,
    tie: str | None = None,
    *,
    previous: dict[str, Column] | None = None,
    running: dict[str, Column] | None = None,
    latest: dict[str, Column] | None = None,
    totals: dict[str, Column] | None = None,
    descending: bool = False,
    slices: Slices | None = None,
) -> DataFrame:
    """Add ordered per-key columns to ``df``.

    ``previous``
        value of an expression on the row before (null on the first row of a key)
    ``running``
        sum of an expression over all rows up to and including this one
    ``latest``
        last non-null value of an expression strictly before this row
    ``totals``
        sum of an expression over the whole key
    ``descending``
        reverse the order, which turns ``previous`` into the next row

    ``order`` and ``tie`` together must order the rows of a key uniquely for reproducible results.
    """
    previous, running = previous or {}, running or {}
    latest, totals = latest or {}, totals or {}
    given = df.columns
    inputs = {f"__p_{n}": e for n, e in previous.items()}
    inputs |= {f"__l_{n}": e for n, e in latest.items()}
    summed = {f"__r_{n}": e for n, e in running.items()}
    summed |= {f"__t_{n}": e for n, e in totals.items()}
    base = df.select("*", *[e.alias(n) for n, e in (inputs | summed).items()])
    base = base.withColumns({n: F.col(n).cast(_sum_type(base.schema[n].dataType)) for n in summed})
    if slices is None:
        slices = plan_slices(df, order, tie)

    sort_columns = [order] + ([tie] if tie else [])
    direction = (lambda c: F.desc_nulls_last(c)) if descending else (lambda c: F.asc_nulls_first(c))
    ordering = [direction(c) for c in sort_columns]

    if slices.single:
        group = Window.partitionBy(*keys)
        ordered = group.orderBy(*ordering)
    else:
        base = _with_slice(base, order, tie, slices).withColumn(_CARRY, F.lit(False))
        base = base.unionByName(
            _carry_rows(base, keys, sort_columns, previous, running, latest, totals, descending),
            allowMissingColumns=True,
        )
        group = Window.partitionBy(*keys, _SLICE)
        ordered = group.orderBy(F.desc(_CARRY), *ordering)

    through = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    columns = [F.lag(f"__p_{n}").over(ordered).alias(n) for n in previous]
    columns += [F.sum(f"__r_{n}").over(through).alias(n) for n in running]
    columns += [F.last(f"__l_{n}", ignorenulls=True).over(before).alias(n) for n in latest]
    if slices.single:
        columns += [F.sum(f"__t_{n}").over(group).alias(n) for n in totals]
    else:
        columns += [F.first(f"__t_{n}").over(through).alias(n) for n in totals]
    scanned = base.select(*given, *([] if slices.single else [_CARRY]), *columns)
    return scanned if slices.single else scanned.where(~F.col(_CARRY)).drop(_CARRY)


def _sum_type(kind: T.DataType) -> T.DataType:
    """Type wide enough for totals over a whole key."""
    if isinstance(kind, T.DecimalType):
        return T.DecimalType(38, kind.scale)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return T.DoubleType()
    return T.LongType()


def _carry_rows(base, keys, sort_columns, previous, running, latest, totals, descending) -> DataFrame:
    """One row per (key, slice) holding what the earlier slices of that key hand over."""
    place = F.struct(*sort_columns)
    ending = F.min_by if descending else F.max_by
    summary = [F.count(F.lit(1)).alias("__n")]
    if previous:
        summary.append(ending(F.struct(*[f"__p_{n}" for n in previous]), place).alias("__end"))
    summary += [F.sum(f"__r_{n}").alias(f"__r_{n}") for n in running]
    summary += [
        ending(f"__l_{n}", F.when(F.col(f"__l_{n}").isNotNull(), place)).alias(f"__l_{n}") for n in latest
    ]
    summary += [F.sum(f"__t_{n}").alias(f"__t_{n}") for n in totals]
    per_slice = base.groupBy(*keys, _SLICE).agg(*summary)

    whole = Window.partitionBy(*keys)
    along = whole.orderBy(F.desc(_SLICE) if descending else F.asc(_SLICE))
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    handed = []
    if previous:
        end = F.lag("__end").over(along)
        handed += [end.getField(f"__p_{n}").alias(f"__p_{n}") for n in previous]
    handed += [F.sum(f"__r_{n}").over(earlier).cast(base.schema[f"__r_{n}"].dataType).alias(f"__r_{n}") for n in running]
    handed += [F.last(f"__l_{n}", ignorenulls=True).over(earlier).alias(f"__l_{n}") for n in latest]
    handed += [F.sum(f"__t_{n}").over(whole).cast(base.schema[f"__t_{n}"].dataType).alias(f"__t_{n}") for n in totals]
    return per_slice.select(*keys, _SLICE, F.lit(True).alias(_CARRY), *handed)


def trailing_sums(
    df: DataFrame,
    keys: list[str],
    ts: str,
    seconds: int,
    sums: dict[str, Column],
    *,
    slices: Slices | None = None,
) -> DataFrame:
    """Sums over the last ``seconds`` (both ends closed), one row per distinct (key, instant).

    Rows of one instant are added up first, on the map side. Each instant then takes part twice: at
    its own time, and as a probe at the far end of its window. One running sum over both gives the
    two prefix totals whose difference is the trailing sum, so the cost does not depend on how many
    rows a window holds. Use exact types (integers, decimals) for the sums.
    """
    instants = df.groupBy(*keys, ts).agg(*[F.sum(e).alias(n) for n, e in sums.items()])
    window = F.expr(f"INTERVAL '{seconds}' SECOND")
    # The names put a probe before an event of the same time.
    ends = {"__0_probe": F.col(ts) - window, "__1_event": F.col(ts)}
    both = instants.withColumns(ends).unpivot([*keys, ts, *sums], list(ends), "__kind", "__at")
    is_event = F.col("__kind") == "__1_event"
    if slices is None:
        at = df.select(F.col(ts).alias("__at"))
        slices = plan_slices(at.union(at.select(F.col("__at") - window)), "__at")
    scanned = ordered_scan(
        both,
        keys,
        "__at",
        "__kind",
        running={f"__c_{n}": F.when(is_event, F.col(n)) for n in sums},
        slices=slices,
    )
    zero = F.lit(0)
    return scanned.groupBy(*keys, ts).agg(
        *[
            (
                F.max(F.when(is_event, F.coalesce(F.col(f"__c_{n}"), zero)))
                - F.max(F.when(~is_event, F.coalesce(F.col(f"__c_{n}"), zero)))
            ).alias(n)
            for n in sums
        ]
    )


def as_of(
    rows: DataFrame,
    versions: DataFrame,
    keys: list[str],
    row_ts: str,
    version_ts: str,
    values: list[str],
    row_id: str,
    *,
    slices: Slices | None = None,
) -> DataFrame:
    """Each row with the newest version strictly older than it; rows without one get nulls.

    ``versions`` holds at most one row per (key, instant) and ``row_id`` is a number, which may be null. Both sides are
    laid on one time axis and scanned once, so no row meets more than one version. Rows without a time have no version.
    """
    # At equal times facts sort before versions, which makes the match strict. What is a fact is marked, not told
    # by its rank, which may be anything.
    rank = F.col(row_id).cast("double")
    facts = rows.select(
        "*",
        F.col(row_ts).alias("__at"),
        F.when(F.isnan(rank) | (rank == _INF), F.lit(_LARGEST)).otherwise(rank).alias("__rank"),
        F.lit(True).alias("__fact"),
    )
    offers = versions.where(F.col(version_ts).isNotNull()).select(
        *keys,
        F.col(version_ts).alias("__at"),
        F.lit(_INF).alias("__rank"),
        F.lit(False).alias("__fact"),
        F.struct(*values).alias("__version"),
    )
    both = facts.unionByName(offers, allowMissingColumns=True)
    if slices is None:
        slices = plan_slices(both, "__at", "__rank")
    scanned = ordered_scan(both, keys, "__at", "__rank", latest={"__match": F.col("__version")}, slices=slices)
    return scanned.where("__fact").select(
        *rows.columns, *[F.col("__match").getField(v).alias(v) for v in values]
    )
