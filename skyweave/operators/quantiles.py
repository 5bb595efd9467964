"""Exact percentiles from counts, with small shuffles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyweave.operators import sequence
from skyweave.operators.sequence import Slices, ordered_scan, plan_slices
from skyweave.session import bounded_side, materialise

# Parts a range of values is divided into at each look, and the number of looks.
PARTS = 4_096
LOOKS = 2
# Below this many values a group is ranked whole.
WHOLE_GROUP = 20_000

_INF = float("inf")


def exact_quantiles(
    df: DataFrame,
    columns: list[str],
    probs: list[float],
    *,
    by: list[str] | None = None,
    measures: list[Column] | None = None,
    whole_group: int | None = None,
    target_rows: int | None = None,
) -> DataFrame:
    """Interpolated percentiles q0, q1, ... and the row count, one row per (group, feature).

    Counts per part of a group's range say in which part each percentile lies; a second look divides those
    parts again. Both are hash aggregates, reduced on the map side. The last pass counts what lies below such a band and
    ranks only the values inside it; repeats collapse on the map side too. ``measures`` are further aggregates over ``value``.
    Groups of up to ``whole_group`` values are ranked whole; bands are sliced if there are more than ``target_rows`` values.
    """
    whole_group = WHOLE_GROUP if whole_group is None else whole_group
    target_rows = target_rows or sequence.TARGET_ROWS
    by = by or []
    keys = [*by, "feature"]
    long = df.unpivot(by, columns, "feature", "value").where(F.col("value").isNotNull())
    finite = F.when((F.col("value") > -_INF) & (F.col("value") < _INF), F.col("value"))
    sizes = long.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_values"),
        F.min(finite).alias("__low"),
        F.max(finite).alias("__high"),
        *(measures or []),
    )
    ends = [F.col("__low").alias(f"__lo{i}") for i in range(len(probs))]
    ends += [F.col("__high").alias(f"__hi{i}") for i in range(len(probs))]
    groups, rows = bounded_side(
        sizes.select("*", *ends).drop("__low", "__high").withColumnsRenamed({k: f"__g_{k}" for k in keys}), "quantile-ends"
    )
    values = sum(r.n_values for r in rows) if rows is not None else None
    if rows is None or any(r.n_values > whole_group for r in rows):
        for _ in range(LOOKS):
            groups, _ = bounded_side(_narrowed(long, groups, keys, probs), "quantile-ends")
    else:
        opened = {f"__{side}{i}": F.lit(None).cast("double") for side in ("lo", "hi") for i in range(len(probs))}
        groups = groups.withColumns(opened)
    ranked = _rank_bands(long, groups, keys, len(probs), values, target_rows)

    def value_at(i: int, rank: Column) -> Column:
        hit = (F.col("__band") == i) & (F.col("__through") > rank) & (F.col("__through") - F.col("__n") <= rank)
        return F.max(F.when(hit, F.col("__v")))

    picks, outputs = [], []
    for i, p in enumerate(probs):
        position = F.lit(float(p)) * (F.col("n_values") - 1)
        picks += [
            value_at(i, F.floor(position)).alias(f"__a{i}"),
            value_at(i, F.ceil(position)).alias(f"__b{i}"),
        ]
        low, high = F.col(f"__a{i}"), F.col(f"__b{i}")
        outputs.append((low + (high - low) * (position - F.floor(position))).alias(f"q{i}"))
    kept = [c for c in groups.columns if not c.startswith("__")]
    found = ranked.join(groups, _same_group(keys)).groupBy(*keys, *kept).agg(*picks)
    return found.select(*keys, *kept, *outputs)


def _narrowed(long: DataFrame, groups: DataFrame, keys: list[str], probs: list[float]) -> DataFrame:
    """``groups`` with each band cut down to the parts of it that hold the two ranks around its percentile."""
    value = F.col("value")

    def part(i: int) -> Column:
        low, high = F.col(f"__lo{i}"), F.col(f"__hi{i}")
        share = F.when(high > low, (value - low) / (high - low))
        inside = F.least(F.floor(share * PARTS), F.lit(PARTS - 1))
        return (
            F.when(F.coalesce(value < low, F.lit(False)) | (value == -_INF), F.lit(-1))
            .when(F.isnan(value) | (value == _INF) | F.coalesce(value > high, F.lit(True)), F.lit(PARTS))
            .otherwise(F.coalesce(inside, F.lit(0)))
        )

    entries = F.array(*[F.struct(F.lit(i).alias("__band"), part(i).cast("int").alias("__part")) for i in range(len(probs))])
    counted = (
        long.join(groups, _same_group(keys))
        .select(*keys, "value", F.inline(entries))
        .groupBy(*keys, "__band", "__part")
        .agg(F.count(F.lit(1)).alias("__n"), F.min("value").alias("__least"), F.max("value").alias("__most"))
    )
    along = Window.partitionBy(*keys, "__band").orderBy("__part")
    through = F.sum("__n").over(along)
    probability = F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.col("__band") + 1)
    placed = (
        counted.withColumn("__through", through)
        .join(groups.select(*[c for c in groups.columns if c.startswith("__g_")], "n_values"), _same_group(keys))
        .withColumn("__position", probability * (F.col("n_values") - 1))
    )

    def holds(rank: Column) -> Column:
        return (F.col("__through") > rank) & (F.col("__through") - F.col("__n") <= rank)

    # Outside the finite range a band stays open: there are only infinities and NaN.
    starts = F.when(holds(F.floor("__position")) & (F.col("__part") >= 0), F.col("__least"))
    stops = F.when(holds(F.ceil("__position")) & (F.col("__part") < PARTS), F.col("__most"))
    edges = placed.groupBy(*[F.col(f"__g_{k}") for k in keys]).agg(
        *[F.min(F.when(F.col("__band") == i, starts)).alias(f"__lo{i}") for i in range(len(probs))],
        *[F.max(F.when(F.col("__band") == i, stops)).alias(f"__hi{i}") for i in range(len(probs))],
    )
    old = groups.drop(*[f"__{side}{i}" for side in ("lo", "hi") for i in range(len(probs))])
    renamed = edges.withColumnsRenamed({f"__g_{k}": f"__e_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"__g_{k}").eqNullSafe(F.col(f"__e_{k}"))
    return old.join(renamed, same).drop(*[f"__e_{k}" for k in keys])


def _same_group(keys: list[str]) -> Column:
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__g_{k}"))
    return same


def _rank_bands(
    long: DataFrame, groups: DataFrame, keys: list[str], bands: int, values: int | None, target_rows: int
) -> DataFrame:
    """Values inside each band with the number of values up to and including them.

    Everything below a band is folded into one entry with a null value, which sorts first, so the
    running count of a band starts at the right rank.
    """
    value = F.col("value")
    entries = F.array(
        *[
            F.struct(
                F.lit(i).alias("__band"),
                F.when(~F.coalesce(value < F.col(f"__lo{i}"), F.lit(False)), value).alias("__v"),
                F.coalesce(value <= F.col(f"__hi{i}"), F.lit(True)).alias("__wanted"),
            )
            for i in range(bands)
        ]
    )
    counted = (
        long.join(groups, _same_group(keys))
        .select(*keys, F.inline(entries))
        .where(F.col("__wanted"))
        .groupBy(*keys, "__band", "__v")
        .agg(F.count(F.lit(1)).alias("__n"))
    )
    slices = Slices()
    if values is None or values > target_rows:
        # Bands of a large input may be large themselves: keep their counts, then cut them evenly.
        counted = materialise(counted, "quantile-bands")
        slices = plan_slices(counted, "__v", target_rows=target_rows)
    return ordered_scan(counted, [*keys, "__band"], "__v", running={"__through": F.col("__n")}, slices=slices)


def step_values(df: DataFrame, columns: list[str], steps: int, target_rows: int | None = None) -> DataFrame:
    """Interpolated percentiles at 1/steps, 2/steps, ... of each column, for many steps: feature, step, value.

    Equal values are counted first, and a running count over the values gives each its ranks; a step needs the values at two ranks.
    One pass over the input, whatever the number of steps. Null and NaN are left out.
    """
    long = df.unpivot([], columns, "feature", "value").where(F.col("value").isNotNull() & ~F.isnan("value"))
    counted = materialise(long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n")), "step-values")
    sizes = counted.groupBy("feature").agg((F.sum("n") - 1).alias("last"))
    slices = plan_slices(counted, "value", target_rows=target_rows)
    through = ordered_scan(counted, ["feature"], "value", running={"through": F.col("n")}, slices=slices)
    # Step i stands at rank i * last / steps. Of a value with the ranks [first, through) these are the steps whose rank, rounded
    # down or up to a whole one, is among them.
    last, steps_col = F.col("last"), F.lit(steps)
    first = F.col("through") - F.col("n")

    def up(ranks: Column) -> Column:
        return F.when(last > 0, F.ceil(ranks * steps_col / last)).otherwise(F.when(ranks > 0, steps_col).otherwise(0))

    def down(ranks: Column) -> Column:
        return F.when(last > 0, F.floor(ranks * steps_col / last)).otherwise(F.when(ranks < 0, -1).otherwise(steps_col))

    def ranged(low: Column, high: Column, side: str) -> Column:
        low, high = F.greatest(low, F.lit(1)).cast("long"), F.least(high, F.lit(steps - 1)).cast("long")
        numbers = F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<bigint>"))
        return F.transform(numbers, lambda i: F.struct(i.alias("step"), F.lit(side).alias("side")))

    hits = F.concat(
        ranged(up(first), up(F.col("through")) - 1, "low"),
        ranged(down(first - 1) + 1, down(F.col("through") - 1), "high"),
    )
    found = (
        through.join(sizes, "feature")
        .select("feature", "value", "last", F.explode(hits).alias("hit"))
        .groupBy("feature", F.col("hit.step").alias("step"))
        .agg(
            F.max(F.when(F.col("hit.side") == "low", F.col("value"))).alias("low"),
            F.max(F.when(F.col("hit.side") == "high", F.col("value"))).alias("high"),
            F.max("last").alias("last"),
        )
    )
    share = (F.col("step") * F.col("last") % steps_col) / steps_col
    value = F.when((share == 0) | (F.col("low") == F.col("high")), F.col("low")).otherwise(
        F.col("low") + (F.col("high") - F.col("low")) * share
    )
    return found.select("feature", "step", value.alias("value"))
