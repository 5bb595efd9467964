"""Route map: where flights begin and end, and how many go from one such place to another."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyweave.functions.geo import grid_column, grid_row
from skyweave.operators.tracks import segments
from skyweave.session import materialise
from skyweave.sources.telemetry import KEY, ROW_ID, TIME

_ENDS = ("origin", "destination")


def segment_ends(df: DataFrame, gap_seconds: int = 1800, key: str = KEY, ts: str = TIME, row_id: str = ROW_ID) -> DataFrame:
    """First and last known position of every flight with two points or more: one row per flight, reduced on the map side."""
    known = df.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    placed = segments(known.select(key, ts, row_id, "latitude", "longitude"), gap_seconds, key, ts, row_id)
    at, point = F.struct(ts, row_id), F.struct("latitude", "longitude")
    return (
        placed.groupBy(key, "segment")
        .agg(F.count(F.lit(1)).alias("n_points"), F.min_by(point, at).alias("origin"), F.max_by(point, at).alias("destination"))
        .where("n_points > 1")
        .drop("n_points")
    )


def _cell(point: str, degrees: float) -> list[Column]:
    """Grid cell of a position; both ends of the grid's rows are one meridian, and the northern edge belongs to the last row."""
    around, rows = round(360 / degrees), round(180 / degrees)
    return [
        F.least(grid_row(F.col(f"{point}.latitude"), degrees), F.lit(rows - 1)).alias("cell_row"),
        F.pmod(grid_column(F.col(f"{point}.longitude"), degrees), F.lit(around)).alias("cell_col"),
    ]


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node``, ``root``: the smallest node each node of ``edges`` (``a``, ``b``) can reach.

    Every round each root that has a lower one across an edge is hooked to the lowest of these, and all nodes step on to the root of
    their root; so groups grow together by multiples, and rounds follow the logarithm of their size. Each round is a written table.
    """
    links = materialise(edges.where("a <> b").select("a", "b").distinct(), f"{name}-edges")
    nodes = links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node"))).distinct()
    labels = materialise(nodes.withColumn("root", F.col("node")), name)
    while True:
        of_a = labels.select(F.col("node").alias("a"), F.col("root").alias("x"))
        of_b = labels.select(F.col("node").alias("b"), F.col("root").alias("y"))
        crossing = links.join(of_a, "a").join(of_b, "b").where("x <> y")
        hooks = crossing.select(F.greatest("x", "y").alias("root"), F.least("x", "y").alias("low")).groupBy("root").agg(F.min("low").alias("low"))
        hooks = materialise(hooks, f"{name}-hooks")
        if hooks.isEmpty():
            return labels
        hooked = materialise(labels.join(hooks, "root", "left").select("node", F.coalesce("low", "root").alias("root")), name)
        ahead = hooked.select(F.col("node").alias("root"), F.col("root").alias("further"))
        labels = materialise(hooked.join(ahead, "root").select("node", F.col("further").alias("root")), name)


def places(ends: DataFrame, degrees: float = 1.0, least: int = 4) -> DataFrame:
    """``cell_row``, ``cell_col``, ``place``: the cells of the places where flights begin or end.

    A cell with ``least`` ends or more is dense. Dense cells that touch, corners included and across the 180th meridian,
    are one place, named by its smallest cell (row * columns + column). Only cells are compared with their eight neighbours,
    never ends with one another.
    """
    around = round(360 / degrees)
    counted = None
    for end in _ENDS:
        part = ends.select(*_cell(end, degrees))
        counted = part if counted is None else counted.unionByName(part)
    dense = counted.groupBy("cell_row", "cell_col").agg(F.count(F.lit(1)).alias("n_ends")).where(F.col("n_ends") >= least)
    dense = materialise(dense.withColumn("node", F.col("cell_row") * around + F.col("cell_col")), "dense-cells")
    steps = F.array(*[F.struct(F.lit(r).alias("r"), F.lit(c).alias("c")) for r, c in ((0, 1), (1, -1), (1, 0), (1, 1))])
    beside = dense.select(F.col("node").alias("a"), "cell_row", "cell_col", F.inline(steps)).select(
        "a", ((F.col("cell_row") + F.col("r")) * around + F.pmod(F.col("cell_col") + F.col("c"), F.lit(around))).alias("b")
    )
    touching = beside.join(dense.select(F.col("node").alias("b")), "b")
    roots = components(touching, "places").select("node", "root")
    return dense.join(roots, "node", "left").select("cell_row", "cell_col", "n_ends", F.coalesce("root", "node").alias("place"))


def route_map(ends: DataFrame, degrees: float = 1.0, least: int = 4) -> DataFrame:
    """``origin``, ``destination``, ``n_flights``: flights between places; null where an end is in no place."""
    found = materialise(places(ends, degrees, least).select("cell_row", "cell_col", "place"), "places")
    placed = ends.select(*[F.struct(*_cell(end, degrees)).alias(end) for end in _ENDS])
    for end in _ENDS:
        of_end = found.select(F.struct("cell_row", "cell_col").alias(end), F.col("place").alias(f"{end}_place"))
        placed = placed.join(of_end, end, "left")
    return placed.groupBy(*[F.col(f"{end}_place").alias(end) for end in _ENDS]).agg(F.count(F.lit(1)).alias("n_flights"))
