"""Mixing sources to target weights along a training schedule, with DataFrame operations only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyweave.llm.workspace import Workspace, null_safe, numbered

WORD = r"[^\x20\x09-\x0D]+"
CELL_ROWS = 1_024
"""Rows of a source whose sizes are added up in one window, on average."""


@dataclass(frozen=True)
class Schedule:
    """Weights of the sources and how they change from the start (0) to the end (1) of the training.

    ``weights`` go to the sources in the order of their names, nulls last, over and over. ``curves`` has for each weight
    the knots (time, factor) of a piecewise linear curve; time runs from 0 to 1 and factors are above 0. The
    target is the area under a source's curve, the shape says when the source is read.
    """

    weights: tuple[float, ...] = (5.0, 2.0, 1.0)
    curves: tuple[tuple[tuple[float, float], ...], ...] = (
        ((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)),
        ((0.0, 1.0), (1.0, 1.0)),
        ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)),
    )
    most_repeats: int = 3

    def segments(self, kind: int) -> list[tuple[float, float, float, float, float]]:
        """Of one curve, scaled to an area of 1: start, end, weight at the start, slope, area before."""
        knots = self.curves[kind]
        steps = list(zip(knots, knots[1:]))
        area = sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in steps)
        out, before = [], 0.0
        for (t0, w0), (t1, w1) in steps:
            out.append((t0, t1, w0 / area, (w1 - w0) / (t1 - t0) / area, before))
            before += (t1 - t0) * (w0 + w1) / 2 / area
        return out


def words_in(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def position(kind: Column, demand: Column, schedule: Schedule) -> Column:
    """When a source has been read up to the share ``demand``: the integrated curve inverted, segment by segment."""
    out = F.lit(1.0)
    for number in range(len(schedule.curves)):
        for t0, t1, w0, slope, before in schedule.segments(number):
            rest = demand - F.lit(before)
            time = rest / F.lit(w0) if slope == 0 else (F.sqrt(F.lit(w0 * w0) + F.lit(2 * slope) * rest) - F.lit(w0)) / F.lit(slope)
            out = F.when((kind == number) & (demand >= before), F.least(F.lit(t0) + time, F.lit(t1))).otherwise(out)
    return out


def targets(sizes: DataFrame, schedule: Schedule) -> DataFrame:
    """``source``, ``source_size``, ``rows`` with ``kind`` (number of the weight) and ``target``.

    The sources share the sum of all sizes by weight; what a target has above ``most_repeats`` times its source goes to the
    others by weight, until none is above. That end is a common level times the weights: in the order of limit by weight it is
    the largest of what is left for the sources from each one on. One row per source goes through one task.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    count = len(schedule.weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in schedule.weights]), F.col("kind") + 1)
    ranked = (
        sizes.withColumn("kind", ((F.row_number().over(by_name) - 1) % count).cast("int"))
        .withColumn("weight", weight)
        .withColumn("most", F.lit(schedule.most_repeats) * F.col("source_size"))
    )
    by_limit = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    after = by_limit.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    all_rows = Window.partitionBy()
    left = F.sum("source_size").over(all_rows) - F.coalesce(F.sum("most").over(before), F.lit(0))
    return (
        ranked.withColumn("level", left.cast("double") / F.sum("weight").over(after))
        .withColumn("level", F.max("level").over(all_rows))
        .withColumn("target", F.least(F.col("most").cast("double"), F.col("level") * F.col("weight")))
        .select("source", "source_size", "rows", "kind", "target")
    )


def mixed(docs: DataFrame, workspace: Workspace, schedule: Schedule = Schedule(), kept_cols: list[str] = ()) -> DataFrame:
    """A row per row of ``docs`` (``doc_id``, ``text``, ``source``): doc_id, size, source, source_size, target, copies, taken,
    positions; ``kept_cols`` come along under the prefix ``in_``.

    ``size`` is the number of words. Each document of a source is taken as often as the target holds the source whole; documents
    are taken once more in the order of a digest of id and text until the rest of the target is met to half a
    document. So reruns agree whatever the partitioning. ``positions`` has the training time of every copy, from the inverse of
    the source's integrated weight at the copy's place in the demand.

    Sizes are summed per cell, a range of digests with about CELL_ROWS rows, then over the cells of a source, and last within a
    cell, so that a source of any size is spread. Null texts have size 0 and null sources are a source, the last one. Rows
    that agree in id and text are interchangeable, each is taken or not by itself. Empty tables give empty
    results; a corpus without a word has targets of 0.
    """
    extra = [F.col(f"`{c}`").alias(f"in_{c}") for c in kept_cols]
    digest = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit(""))))
    rows = workspace.keep(
        numbered(
            docs.select(
                "doc_id",
                F.col("source").cast("string").alias("source"),
                words_in("text").alias("size"),
                F.conv(F.substring(digest, 1, 13), 16, 10).cast("long").alias("place"),
                *extra,
            )
        ),
        "rows",
    )
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    goals = workspace.keep(targets(sizes, schedule), "targets")
    cells = F.ceil(F.col("rows") / CELL_ROWS)
    placed = (
        rows.join(goals, rows["source"].eqNullSafe(goals["source"]))
        .drop(goals["source"])
        .withColumn("cell", F.floor(F.col("place") / F.lit(float(16**13)) * cells))
    )
    in_source = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = workspace.keep(
        placed.groupBy("source", "cell")
        .agg(F.sum("size").alias("cell_size"))
        .withColumn("cell_start", F.coalesce(F.sum("cell_size").over(in_source), F.lit(0)))
        .select("source", "cell", "cell_start"),
        "cells",
    )
    in_cell = Window.partitionBy("source", "cell").orderBy("place", "doc_id", "row_id")
    found = (
        placed.join(starts, null_safe(placed, starts, ["source", "cell"]))
        .drop(starts["source"])
        .drop(starts["cell"])
        .withColumn(
            "start",
            F.col("cell_start")
            + F.coalesce(F.sum("size").over(in_cell.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        )
    )
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.col("target") - F.col("whole") * F.col("source_size")
    more = (F.col("start") + F.col("size") / 2.0 < rest).cast("int")
    copies = F.least(F.col("whole") + more, F.lit(schedule.most_repeats)).cast("int")
    found = (
        found.withColumn("whole", whole)
        .withColumn("copies", F.when(F.col("target") > 0, copies).otherwise(F.lit(0)))
        .withColumn("taken", F.col("size") * F.col("copies"))
    )

    def at(copy: Column) -> Column:
        demand = (copy * F.col("source_size") + F.col("start") + F.col("size") / 2.0) / F.col("target")
        return position(F.col("kind"), F.least(demand, F.lit(1.0)), schedule)

    times = F.when(F.col("copies") > 0, F.transform(F.sequence(F.lit(0), F.col("copies") - 1), at))
    return found.withColumn("positions", F.coalesce(times, F.array().cast("array<double>"))).select(
        "doc_id", "size", "source", "source_size", "target", "copies", "taken", "positions",
        *[f"in_{c}" for c in kept_cols],
    )


def arranged(found: DataFrame) -> DataFrame:
    """A row per copy of ``mixed`` with its ``position``, sorted by it over all partitions."""
    return found.withColumn("position", F.explode("positions")).orderBy("position")
