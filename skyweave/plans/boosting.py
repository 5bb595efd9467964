"""Gradient boosting of several classes over binned features.

Each round fits one tree per class to the gradients of the softmax loss. All trees of a round grow together, level by level: one
pass over the rows adds up gradients, curvatures and rows by (class, node, feature, bin), whose size does not depend on the rows. The
sums of a class meet in one task, which chooses the splits of the level; only the splits reach the driver.

Rows are binned once, to one byte per feature, and kept in blocks. What a block's margins are follows from its rows and the trees
so far; a worker that has seen the block in an earlier round only adds the trees that are new to it, another one those since
the margins were last stored with the block.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Model
from pyspark.ml.feature import Bucketizer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyweave.operators.quantiles import step_values
from skyweave.session import materialise

BINS = 255
"""Bins of a feature; one more holds null and NaN."""

BLOCK_ROWS = 32_768
STORE_ROUNDS = 10
"""Rounds after which blocks are stored with their margins."""
PARTIALS = 64
"""Most parts whose sums of a class are added in one task; more are added in lots first."""


def bin_edges(df: DataFrame, columns: list[str], bins: int = BINS) -> dict[str, list[float]]:
    """Per column the increasing lower ends of its bins but the first: exact percentiles at equal steps, without repeats.

    Null and NaN have no part in them. A column without values has no edges.
    """
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    found = {c: set() for c in columns}
    for row in step_values(rows, columns, bins).collect():
        if abs(row["value"]) < np.inf:
            found[row["feature"]].add(row["value"])
    return {c: sorted(cuts) for c, cuts in found.items()}


def binned(df: DataFrame, edges: dict[str, list[float]], suffix: str = "_bin") -> DataFrame:
    """``df`` with the bin of each column: the number of its edges that are not above the value; null and NaN come last."""
    for column, cuts in edges.items():
        placed = df.withColumn("__value", F.col(column).cast("double"))
        if cuts:
            inner = [-np.inf, *cuts, np.inf]
            placed = Bucketizer(inputCol="__value", outputCol="__bin", splits=inner, handleInvalid="keep").transform(placed)
        else:
            placed = placed.withColumn("__bin", F.lit(0.0))
        last = F.col("__value").isNull() | F.isnan("__value")
        df = placed.withColumn(f"{column}{suffix}", F.when(last, F.lit(len(cuts) + 1)).otherwise(F.col("__bin").cast("int")))
        df = df.drop("__value", "__bin")
    return df


@dataclass(frozen=True)
class Growth:
    """How trees grow: sums below ``least_rows`` rows or ``least_curvature`` are not split off."""

    rate: float = 0.1
    depth: int = 5
    least_rows: int = 20
    least_curvature: float = 1e-3
    ridge: float = 0.0


@dataclass
class Tree:
    """A tree of fixed depth in arrays; node i has the children 2i + 1 and 2i + 2. Bins up to ``cut`` go left, and null and NaN go
    where ``last_left`` says; a feature of -1 is a node that is not split, whose rows all go left."""

    feature: np.ndarray
    cut: np.ndarray
    last_left: np.ndarray
    value: np.ndarray

    @staticmethod
    def empty(depth: int) -> Tree:
        inner, all_nodes = 2**depth - 1, 2 ** (depth + 1) - 1
        return Tree(
            np.full(inner, -1, dtype=np.int16), np.zeros(inner, dtype=np.int16), np.zeros(inner, dtype=bool), np.zeros(all_nodes)
        )

    def nodes(self, bins: np.ndarray, last: np.ndarray, levels: int) -> np.ndarray:
        """The node of each row (columns of ``bins``) after so many levels."""
        at = np.zeros(bins.shape[1], dtype=np.int64)
        rows = np.arange(bins.shape[1])
        for _ in range(levels):
            feature = self.feature[at]
            own = bins[np.maximum(feature, 0), rows]
            left = np.where(own == last[feature], self.last_left[at], own <= self.cut[at]) | (feature < 0)
            at = 2 * at + np.where(left, 1, 2)
        return at

    def to_json(self) -> list:
        return [self.feature.tolist(), self.cut.tolist(), self.last_left.tolist(), self.value.tolist()]

    @staticmethod
    def from_json(parts: list) -> Tree:
        kinds = (np.int16, np.int16, bool, np.float64)
        return Tree(*[np.array(p, dtype=k) for p, k in zip(parts, kinds)])

    @property
    def depth(self) -> int:
        return (len(self.feature) + 1).bit_length() - 1


def packed(trees: list[list[Tree]]) -> tuple[np.ndarray, ...] | None:
    """All rounds as four arrays (rounds, classes, nodes), which travel to the workers fast."""
    if not trees:
        return None
    return tuple(np.stack([[getattr(t, name) for t in r] for r in trees]) for name in ("feature", "cut", "last_left", "value"))


def unpacked(arrays: tuple[np.ndarray, ...] | None, first: int = 0) -> list[list[Tree]]:
    """The rounds from ``first`` on."""
    if arrays is None:
        return []
    return [[Tree(*[a[r, k] for a in arrays]) for k in range(arrays[0].shape[1])] for r in range(first, len(arrays[0]))]


def margins(trees: list[list[Tree]], start: np.ndarray, bins: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Margins (classes, rows) of the rows after all rounds of ``trees``."""
    total = np.repeat(start[:, None], bins.shape[1], axis=1)
    for round_trees in trees:
        for k, tree in enumerate(round_trees):
            total[k] += tree.value[tree.nodes(bins, last, tree.depth)]
    return total


def gradients(total: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of the weighted softmax loss by each margin."""
    share = np.exp(total - total.max(axis=0))
    share /= share.sum(axis=0)
    first = share.copy()
    first[label, np.arange(len(label))] -= 1.0
    return weight * first, weight * share * (1.0 - share)


def level_sums(
    bins: np.ndarray, first: np.ndarray, second: np.ndarray, at: np.ndarray, level: int, width: int
) -> np.ndarray:
    """Sums (classes, nodes of the level, features, bins, 3) of gradients, curvatures and rows."""
    classes, features = len(first), len(bins)
    nodes, base = 2**level, 2**level - 1
    out = np.empty((classes, features, nodes * width, 3))
    for k in range(classes):
        offset = (at[k] - base) * width
        for f in range(features):
            slot = offset + bins[f]
            out[k, f, :, 0] = np.bincount(slot, weights=first[k], minlength=nodes * width)
            out[k, f, :, 1] = np.bincount(slot, weights=second[k], minlength=nodes * width)
            out[k, f, :, 2] = np.bincount(slot, minlength=nodes * width)
    return out.reshape(classes, features, nodes, width, 3).transpose(0, 2, 1, 3, 4)


def choose_splits(sums: np.ndarray, trees: list[Tree], level: int, last: np.ndarray, growth: Growth) -> None:
    """Set the splits of a level, and the values of the nodes they make, from the sums of the level.

    Null and NaN are tried on either side. Of gains that agree to nine digits the first feature, side and cut win.
    """
    classes, nodes, features, width, _ = sums.shape
    base = 2**level - 1
    missing = np.stack([sums[:, :, f, last[f]] for f in range(features)], axis=2)
    own = sums.copy()
    cuts = np.zeros((features, 2, width), dtype=bool)
    for f in range(features):
        own[:, :, f, last[f] :] = 0
        cuts[f, :, : last[f]] = True
    below = np.cumsum(own, axis=3)
    left = np.stack([below, below + missing[:, :, :, None]], axis=3)
    whole = sums[:, :, 0].sum(axis=2)
    right = whole[:, :, None, None, None] - left
    fits = cuts & np.stack([np.ones(missing.shape[:3], bool), missing[..., 2] > 0], axis=3)[..., None]
    for side in (left, right):
        fits = fits & (side[..., 2] >= growth.least_rows) & (side[..., 1] >= growth.least_curvature)
    gain = np.where(fits, _gain(left, growth) + _gain(right, growth) - _gain(whole, growth)[:, :, None, None, None], -np.inf)
    gain = gain.reshape(classes, nodes, -1)
    top = gain.max(axis=2)
    chosen = np.argmax(gain >= (top - 1e-9 * np.maximum(1.0, np.abs(top)))[:, :, None], axis=2)
    for k in range(classes):
        for j in range(nodes):
            node, tree = base + j, trees[k]
            if not top[k, j] > 1e-9:
                # All rows of the node go on to its left child, which keeps the node's value.
                tree.value[2 * node + 1] = _value(whole[k, j], growth)
                continue
            f, side, cut = np.unravel_index(chosen[k, j], (features, 2, width))
            tree.feature[node], tree.cut[node], tree.last_left[node] = f, cut, bool(side)
            tree.value[2 * node + 1] = _value(left[k, j, f, side, cut], growth)
            tree.value[2 * node + 2] = _value(right[k, j, f, side, cut], growth)


def _gain(sums: np.ndarray, growth: Growth) -> np.ndarray:
    return sums[..., 0] ** 2 / np.maximum(sums[..., 1] + growth.ridge, 1e-300)


def _value(sums: np.ndarray, growth: Growth) -> float:
    weight = sums[1] + growth.ridge
    return float(-growth.rate * sums[0] / weight) if weight > 1e-300 else 0.0


# Margins of the blocks this worker has met, by fit and block: (rounds counted in, margins). Only a saving: any entry may be
# missing, and is then made from the rows and the trees.
_seen: dict[tuple[str, int], tuple[int, np.ndarray]] = {}


def _block_margins(fit: str, number: int, trees: tuple[np.ndarray, ...] | None, start, bins, last, stored=()) -> np.ndarray:
    """Margins of a block after all ``trees``; ``stored`` is what the block brings along: rounds counted in, margins."""
    done = 0 if trees is None else len(trees[0])
    for other in [key for key in _seen if key[0] != fit]:
        del _seen[other]
    rounds, total = _seen.get((fit, number), (0, None))
    if total is None or rounds > done:
        rounds, total = 0, np.repeat(start[:, None], bins.shape[1], axis=1)
        if stored:
            rounds, total = stored[0], np.frombuffer(stored[1]).reshape(len(start), -1)
    if rounds < done:
        total = total + margins(unpacked(trees, rounds), np.zeros(len(start)), bins, last)
        _seen[fit, number] = (done, total)
    return total


_BLOCKS = "number long, size int, bins binary, label binary, weight binary"


def _packer(features: int):
    """Rows (bins of the features, label, weight) to blocks."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                bins = np.stack([part.column(f).to_numpy().astype(np.uint8) for f in range(features)])
                label = part.column(features).to_numpy().astype(np.uint8)
                weight = part.column(features + 1).to_numpy().astype(np.float64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number]), pa.array([part.num_rows], pa.int32())]
                    + [pa.array([x.tobytes()], pa.binary()) for x in (bins, label, weight)],
                    names=[c.split()[0] for c in _BLOCKS.split(", ")],
                )
                number += 1

    return pack


def _summer(fit: str, trees: tuple[np.ndarray, ...] | None, growing: list[Tree], level: int, start, last, width: int):
    """Sums of a level over the blocks of a task: by class, with the number of the task."""

    def add_up(blocks: Iterator[tuple]) -> Iterator[tuple[int, tuple[int, bytes]]]:
        from pyspark import TaskContext

        total = None
        for number, n, bins, label, weight, *stored in blocks:
            bins = np.frombuffer(bins, dtype=np.uint8).reshape(-1, n)
            label = np.frombuffer(label, dtype=np.uint8)
            weight = np.frombuffer(weight)
            first, second = gradients(_block_margins(fit, number, trees, start, bins, last, stored), label, weight)
            at = np.stack([tree.nodes(bins, last, level) for tree in growing])
            part = level_sums(bins, first, second, at, level, width)
            total = part if total is None else total + part
        if total is not None:
            for k, sums in enumerate(total):
                yield k, (TaskContext.get().partitionId(), sums.tobytes())

    return add_up


def _storer(fit: str, trees: tuple[np.ndarray, ...], start, last):
    """Blocks with their margins after all ``trees``."""

    def store(block: tuple) -> tuple:
        number, n, bins, label, weight, *stored = block
        cells = np.frombuffer(bins, dtype=np.uint8).reshape(-1, n)
        total = _block_margins(fit, number, trees, start, cells, last, stored)
        return number, n, bins, label, weight, len(trees[0]), total.tobytes()

    return store


def _total(parts) -> np.ndarray:
    """Sums of a class, added in the order of the tasks, so that no order of arrival changes them."""
    return sum(np.frombuffer(sums) for _, sums in sorted(parts, key=lambda p: p[0]))


def _in_lot(row: tuple) -> tuple:
    return (row[0], row[1][0] % PARTIALS), row[1]


def _added(row: tuple) -> tuple:
    (k, lot), parts = row
    return k, (lot, _total(parts).tobytes())


def _chooser(level: int, last: np.ndarray, width: int, growth: Growth):
    """The sums of a class to the splits of its level and the values of the nodes they make."""

    def choose(row: tuple) -> tuple:
        tree, base, end = Tree.empty(growth.depth), 2**level - 1, 2 ** (level + 1) - 1
        choose_splits(_total(row[1]).reshape(1, 2**level, len(last), width, 3), [tree], level, last, growth)
        return row[0], tree.feature[base:end], tree.cut[base:end], tree.last_left[base:end], tree.value[end : 2 * end + 1]

    return choose


def _set_splits(found: list[tuple], trees: list[Tree], level: int) -> None:
    base, end = 2**level - 1, 2 ** (level + 1) - 1
    for k, feature, cut, last_left, value in found:
        tree = trees[k]
        tree.feature[base:end], tree.cut[base:end], tree.last_left[base:end] = feature, cut, last_left
        tree.value[end : 2 * end + 1] = value


def fit_boosting(
    df: DataFrame,
    features: list[str],
    label_index: str,
    weight: str,
    classes: int,
    rounds: int = 200,
    growth: Growth | None = None,
    bins: int = BINS,
) -> BoostedTrees:
    """Fit ``rounds`` rounds of one tree per class. ``label_index`` has 0 .. classes - 1, ``weight`` the weight of a row.

    Null and NaN features have a bin of their own and go to the better side of a split. An empty input gives a model of its start
    margins, all zero.
    """
    growth = growth or Growth()
    spark = df.sparkSession
    edges = bin_edges(df, features, bins)
    last = np.array([len(edges[f]) + 1 for f in features])
    width = int(last.max()) + 1
    placed = binned(df, edges).select(*[f"{f}_bin" for f in features], label_index, weight)
    totals = {int(r[0]): r[1] for r in df.groupBy(label_index).agg(F.sum(weight)).collect()}
    mass = np.array([totals.get(k, 0.0) for k in range(classes)])
    start = np.log(np.maximum(mass, 1e-12) / mass.sum()) if mass.sum() > 0 else np.zeros(classes)
    blocks = materialise(placed.mapInArrow(_packer(len(features)), _BLOCKS), "boosting-blocks")
    # A fit has a thousand small jobs, which start faster without plans.
    held = blocks.rdd.map(tuple).persist(StorageLevel.MEMORY_AND_DISK)
    count, tasks = held.count(), held.getNumPartitions()
    fit, trees = f"{id(held)}-{np.random.default_rng().integers(2**62)}", []
    try:
        for done in range(rounds if count else 0):
            so_far = packed(trees)
            if done and done % STORE_ROUNDS == 0:
                stored = held.map(_storer(fit, so_far, start, last)).persist(StorageLevel.MEMORY_AND_DISK)
                stored.count()
                held.unpersist()
                held = stored
            growing = [Tree.empty(growth.depth) for _ in range(classes)]
            for level in range(growth.depth):
                part = _summer(fit, so_far, growing, level, start, last, width)
                sums = held.mapPartitions(part)
                if tasks > PARTIALS:
                    sums = sums.map(_in_lot).groupByKey(classes * PARTIALS).map(_added)
                # A single task has the whole sums already.
                met = sums.mapValues(lambda s: [s]) if tasks == 1 else sums.groupByKey(classes)
                _set_splits(met.map(_chooser(level, last, width, growth)).collect(), growing, level)
            trees.append(growing)
    finally:
        held.unpersist()
    state = {
        "features": features,
        "edges": [edges[f] for f in features],
        "start": start.tolist(),
        "trees": [[t.to_json() for t in round_trees] for round_trees in trees],
    }
    return BoostedTrees(state=json.dumps(state))


class BoostedTrees(Model, DefaultParamsReadable, DefaultParamsWritable):
    """The fitted model as a stage of a pipeline: adds ``prediction``, the index of the class with the highest margin, and
    ``margins``. Ties go to the first class."""

    state = Param(Params._dummy(), "state", "edges, start margins and trees as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, state: str | None = None):
        super().__init__()
        if state is not None:
            self._set(state=state)

    def _opened(self):
        held = json.loads(self.getOrDefault(self.state))
        edges = [np.array(e) for e in held["edges"]]
        trees = [[Tree.from_json(t) for t in round_trees] for round_trees in held["trees"]]
        return held["features"], edges, np.array(held["start"]), trees

    def _transform(self, dataset: DataFrame) -> DataFrame:
        features, edges, start, trees = self._opened()
        last = np.array([len(e) + 1 for e in edges])

        @F.pandas_udf("array<double>")
        def scored(*columns: pd.Series) -> pd.Series:
            values = [c.to_numpy(dtype=np.float64, na_value=np.nan) for c in columns]
            bins = np.stack(
                [np.where(np.isnan(v), n, np.searchsorted(e, v, side="right")) for v, e, n in zip(values, edges, last)]
            )
            return pd.Series(list(margins(trees, start, bins, last).T))

        highest = F.array_position("margins", F.array_max("margins")) - 1
        return dataset.withColumn("margins", scored(*[F.col(f).cast("double") for f in features])).withColumn(
            "prediction", highest.cast("double")
        )
