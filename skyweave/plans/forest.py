"""Random forests over binned features, none of whose nodes reach the driver.

Rows are binned once, to one byte per feature, and kept in blocks. Which rows a tree draws, and which features a node may use, follow
from the seed, so any task can say them again. Up to ``LOCAL_ROWS`` rows, tasks get a copy of the blocks and grow several trees each.
Of more rows, the upper levels come from sums by (tree, node, feature, bin, class) over all blocks, until a node has so few rows
that one task can finish it; then the rows of these nodes are sent there, in lots of trees that bound the shuffle.

Fitted trees are rows of a table. A scoring task reads them one by one from the shared folder, which ``pyarrow.fs`` must be able to open.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyweave.plans.boosting import _BLOCKS, _packer, bin_edges, binned
from skyweave.session import materialise, scratch_path

BINS = 32

LOCAL_ROWS = 1 << 20
"""Most rows a task grows nodes from by itself."""
LOT_BYTES = 1 << 30
"""Bytes of rows that are sent to the nodes of a lot of trees."""
COPIES = 4
"""Copies of the blocks for each core, where all of a tree is grown in one task."""
NODES_AT_ONCE = 2048
SCORE_ROWS = 1 << 16
WHOLE = 1 << 20
"""The votes of a leaf add up to this; whole numbers give the same sums in any order."""

_NODES = "tree int, feature binary, cut binary, child binary, votes binary"


@dataclass
class Nodes:
    """A tree in arrays. Bins up to ``cut`` go on to ``child``, others to the node after it; a leaf is its own child, with a cut above
    all bins. ``votes`` has the shares of the classes at each node."""

    feature: np.ndarray
    cut: np.ndarray
    child: np.ndarray
    votes: np.ndarray

    def to_row(self, tree: int) -> tuple:
        return tree, self.feature.tobytes(), self.cut.tobytes(), self.child.tobytes(), self.votes.tobytes()

    @staticmethod
    def from_row(feature: bytes, cut: bytes, child: bytes, votes: bytes) -> Nodes:
        feature, cut = np.frombuffer(feature, dtype=np.uint8), np.frombuffer(cut, dtype=np.uint8)
        return Nodes(feature, cut, np.frombuffer(child, dtype=np.int32), np.frombuffer(votes, dtype=np.int32).reshape(len(cut), -1))

    def find(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of each row (columns of ``bins``)."""
        n = bins.shape[1]
        flat, rows, at = bins.reshape(-1), np.arange(n), np.zeros(n, dtype=np.int32)
        while True:
            onward = self.child[at] + (flat[self.feature[at] * np.int64(n) + rows] > self.cut[at])
            if np.array_equal(onward, at):
                return at
            at = onward

    def pruned(self) -> Nodes:
        """Without the splits both of whose leaves have the same class on top; such a node is a leaf itself."""
        top, own = self.votes.argmax(axis=1), np.arange(len(self.cut), dtype=np.int32)
        feature, cut, child = self.feature.copy(), self.cut.copy(), self.child.copy()
        while True:
            split = np.flatnonzero(child != own)
            left = child[split]
            ends = (child[left] == left) & (child[left + 1] == left + 1) & (top[left] == top[left + 1])
            if not ends.any():
                break
            merged = split[ends]
            feature[merged], cut[merged], child[merged] = 0, 255, merged
        kept, front = np.zeros(len(cut), dtype=bool), np.zeros(1, dtype=np.int32)
        while len(front):
            kept[front] = True
            onward = child[front[child[front] != front]]
            front = np.concatenate([onward, onward + 1])
        place = (np.cumsum(kept) - 1).astype(np.int32)
        return Nodes(feature[kept], cut[kept], place[child[kept]], self.votes[kept])


def drawn(seed: int, tree: int, block: int, rows: int) -> np.ndarray:
    """How often a tree has drawn each row of a block."""
    return np.random.default_rng([seed, tree, block]).poisson(1.0, rows).astype(np.uint8)


def allowed(seed: int, tree: int, place: int, nodes: int, features: int, most: int) -> np.ndarray:
    """The features (nodes, most) that the nodes of a level may be split by; ``place`` says which level."""
    order = np.random.default_rng([seed, tree, place, 1]).random((nodes, features))
    return np.argsort(order, axis=1)[:, :most]


def sums_of(bins: np.ndarray, label: np.ndarray, times: np.ndarray, node: np.ndarray, choice: np.ndarray, width: int, classes: int):
    """Rows by (node, choice, bin, class); ``node`` is a row of ``choice``."""
    nodes, most = choice.shape
    n = bins.shape[1]
    flat, rows = bins.reshape(-1), np.arange(n)
    out = np.empty((nodes, most, width, classes))
    base = node * np.int64(width * classes) + label
    for j in range(most):
        own = flat[choice[node, j] * n + rows].astype(np.int64)
        out[:, j] = np.bincount(base + own * classes, weights=times, minlength=nodes * width * classes).reshape(nodes, width, classes)
    return out


def best_splits(sums: np.ndarray, weights: np.ndarray):
    """Per node the choice and the cut with the highest fall of the Gini impurity, whether it is a split at all, and the rows by class
    left of it."""
    nodes, most, width, classes = sums.shape
    left = np.cumsum(sums, axis=2)[:, :, :-1]
    whole = sums[:, :1].sum(axis=2)[:, :, None]
    mass_left, mass = left * weights, whole * weights
    mass_right = (whole - left) * weights
    on_left, on_right = mass_left.sum(axis=3), mass_right.sum(axis=3)
    fits = (left.sum(axis=3) > 0) & ((whole - left).sum(axis=3) > 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (mass_left**2).sum(axis=3) / on_left + (mass_right**2).sum(axis=3) / on_right
    total = mass.sum(axis=3)
    gain -= (mass**2).sum(axis=3) / np.where(total > 0, total, 1.0)
    gain = np.where(fits, gain, -np.inf).reshape(nodes, -1)
    best = np.argmax(gain, axis=1)
    is_split = gain[np.arange(nodes), best] > 1e-9 * total[:, 0, 0]
    choice, cut = np.divmod(best, width - 1)
    return choice, cut, is_split, left[np.arange(nodes), choice, cut]


def votes_of(rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Shares of the classes (nodes, classes) from rows by class."""
    mass = rows * weights
    total = mass.sum(axis=1, keepdims=True)
    return np.round(WHOLE * mass / np.where(total > 0, total, 1.0)).astype(np.int32)


@dataclass(frozen=True)
class Plan:
    """What all trees of a forest have in common."""

    seed: int
    depth: int
    most: int
    width: int
    weights: np.ndarray

    @property
    def classes(self) -> int:
        return len(self.weights)


def grow(bins: np.ndarray, label: np.ndarray, times: np.ndarray, plan: Plan, tree: int, level: int = 0, piece: int = 0) -> Nodes:
    """The nodes under one node at ``level``, from all of its rows."""
    held = times > 0
    bins, label, times = np.ascontiguousarray(bins[:, held]), label[held].astype(np.int64), times[held].astype(np.float64)
    features, classes, weights = len(bins), plan.classes, plan.weights
    node, nodes, base = np.zeros(len(label), dtype=np.int64), 1, 0
    made = Nodes([], [], [], [])
    while nodes:
        rows = np.bincount(node * classes + label, weights=times, minlength=nodes * classes).reshape(nodes, classes)
        feature, cut = np.zeros(nodes, dtype=np.uint8), np.full(nodes, 255, dtype=np.uint8)
        is_split = np.zeros(nodes, dtype=bool)
        mixed = (rows > 0).sum(axis=1) > 1
        if level < plan.depth and mixed.any():
            choices = allowed(plan.seed, tree, piece << 8 | level, nodes, features, plan.most)
            for first in range(0, nodes, NODES_AT_ONCE):
                upto = min(first + NODES_AT_ONCE, nodes)
                some = np.flatnonzero(mixed[node] & (node >= first) & (node < upto))
                own, choice = node[some] - first, choices[first:upto]
                sums = sums_of(bins[:, some], label[some], times[some], own, choice, plan.width, classes)
                picked, at, found, _ = best_splits(sums, weights)
                is_split[first:upto] = found
                feature[first:upto] = np.where(found, choice[np.arange(upto - first), picked], 0)
                cut[first:upto] = np.where(found, at, 255)
        child = base + np.arange(nodes)
        rank = np.cumsum(is_split) - 1
        child[is_split] = base + nodes + 2 * rank[is_split]
        for kept, part in zip((made.feature, made.cut, made.child, made.votes), (feature, cut, child, votes_of(rows, weights))):
            kept.append(part)
        on = np.flatnonzero(is_split[node])
        bins, label, times, node = np.ascontiguousarray(bins[:, on]), label[on], times[on], node[on]
        right = bins.reshape(-1)[feature[node] * np.int64(len(on)) + np.arange(len(on))] > cut[node]
        node = 2 * rank[node] + right
        base, nodes, level = base + nodes, 2 * int(is_split.sum()), level + 1
    return Nodes(*[np.concatenate(part) for part in (made.feature, made.cut)], np.concatenate(made.child).astype(np.int32), np.concatenate(made.votes))


def _opened(block: tuple) -> tuple[int, np.ndarray, np.ndarray]:
    number, n, bins, label = block[:4]
    return number, np.frombuffer(bins, dtype=np.uint8).reshape(-1, n), np.frombuffer(label, dtype=np.uint8)


def _whole_trees(plan: Plan, trees: int, copies: int):
    """Copy k of all blocks to the trees k, k + copies, ..."""

    def run(items: Iterator[tuple]) -> Iterator[tuple]:
        copy, blocks = None, []
        for copy, block in items:
            blocks.append(_opened(block))
        if not blocks:
            return
        blocks.sort(key=lambda b: b[0])
        sizes = [(number, len(label)) for number, _, label in blocks]
        bins, label = np.concatenate([b for _, b, _ in blocks], axis=1), np.concatenate([x for *_, x in blocks])
        del blocks
        for tree in range(copy, trees, copies):
            times = np.concatenate([drawn(plan.seed, tree, number, n) for number, n in sizes])
            yield grow(bins, label, times, plan, tree).pruned().to_row(tree)

    return run


@dataclass
class Top:
    """The upper nodes of a tree. ``state`` of a node: ``open`` nodes are still to be split over all blocks, ``small`` ones in one task."""

    feature: list = field(default_factory=lambda: [0])
    cut: list = field(default_factory=lambda: [255])
    child: list = field(default_factory=lambda: [0])
    level: list = field(default_factory=lambda: [0])
    state: list = field(default_factory=lambda: ["open"])
    rows: list = field(default_factory=lambda: [None])

    def having(self, state: str) -> list[int]:
        return [i for i, s in enumerate(self.state) if s == state]

    def nodes(self) -> Nodes:
        kinds = (np.uint8, np.uint8, np.int32)
        return Nodes(*[np.array(x, dtype=k) for x, k in zip((self.feature, self.cut, self.child), kinds)], None)

    def add(self, rows: np.ndarray, level: int, plan: Plan) -> None:
        done = level >= plan.depth or (rows > 0).sum() < 2
        self.state.append("leaf" if done else "small" if rows.sum() <= LOCAL_ROWS else "open")
        for kept, value in ((self.feature, 0), (self.cut, 255), (self.child, len(self.child)), (self.level, level), (self.rows, rows)):
            kept.append(value)

    def settle(self, found: tuple, plan: Plan) -> None:
        """Take up the splits of the open nodes."""
        for node, feature, cut, is_split, left, rows in zip(self.having("open"), *found):
            self.rows[node] = rows
            self.state[node] = "leaf"
            if is_split:
                self.state[node] = "split"
                self.feature[node], self.cut[node], self.child[node] = int(feature), int(cut), len(self.child)
                self.add(left, self.level[node] + 1, plan)
                self.add(rows - left, self.level[node] + 1, plan)


def _open_sums(plan: Plan, tops: dict[int, Top]):
    """Sums over the blocks of a task for the open nodes of each tree."""
    places = {tree: (top.nodes(), np.array(top.having("open"))) for tree, top in tops.items()}

    def run(blocks: Iterator[tuple]) -> Iterator[tuple]:
        total: dict[int, np.ndarray] = {}
        for number, bins, label in map(_opened, blocks):
            for tree, (top, wanted) in places.items():
                number_of = np.full(len(top.cut), -1)
                number_of[wanted] = np.arange(len(wanted))
                times = drawn(plan.seed, tree, number, len(label))
                node = number_of[top.find(bins)]
                some = np.flatnonzero((node >= 0) & (times > 0))
                choice = allowed(plan.seed, tree, int(wanted[0]) << 9, len(wanted), len(bins), plan.most)
                own = label[some].astype(np.int64)
                part = sums_of(bins[:, some], own, times[some].astype(np.float64), node[some], choice, plan.width, plan.classes)
                total[tree] = total[tree] + part if tree in total else part
        yield from total.items()

    return run


def _open_splits(plan: Plan, features: int, first: dict[int, int]):
    """The splits of the open nodes of a tree from their whole sums."""

    def run(item: tuple) -> tuple:
        tree, sums = item
        choice = allowed(plan.seed, tree, first[tree] << 9, len(sums), features, plan.most)
        picked, cut, is_split, left = best_splits(sums, plan.weights)
        return tree, (choice[np.arange(len(sums)), picked], cut, is_split, left, sums[:, 0].sum(axis=1))

    return run


def _to_pieces(plan: Plan, tops: dict[int, Top], numbers: dict[tuple[int, int], int]):
    """A block to the drawn rows of each small node."""
    places = {tree: (top.nodes(), top.having("small")) for tree, top in tops.items()}

    def run(block: tuple) -> Iterator[tuple]:
        number, bins, label = _opened(block)
        for tree, (top, wanted) in places.items():
            times = drawn(plan.seed, tree, number, len(label))
            node = top.find(bins)
            for small in wanted:
                some = np.flatnonzero((node == small) & (times > 0))
                if len(some):
                    sent = (bins[:, some].tobytes(), label[some].tobytes(), times[some].tobytes())
                    yield numbers[tree, small], (tree, small, number, len(some), *sent)

    return run


def _grown_pieces(plan: Plan, levels: dict[tuple[int, int], int]):
    """The rows of small nodes to the nodes under each."""

    def run(items: Iterator[tuple]) -> Iterator[tuple]:
        held: dict[tuple[int, int], list] = {}
        for _, (tree, small, number, n, bins, label, times) in items:
            block = (number, np.frombuffer(bins, dtype=np.uint8).reshape(-1, n), label, times)
            held.setdefault((tree, small), []).append(block)
        for tree, small in sorted(held):
            blocks = sorted(held.pop((tree, small)), key=lambda b: b[0])
            bins = np.concatenate([b[1] for b in blocks], axis=1)
            label, times = (np.frombuffer(b"".join(b[i] for b in blocks), dtype=np.uint8) for i in (2, 3))
            del blocks
            yield tree, (small, grow(bins, label, times, plan, tree, levels[tree, small], small))

    return run


def _joined(plan: Plan, tops: dict[int, Top]):
    """The upper nodes of a tree and what has grown under them, as one tree."""

    def run(item: tuple) -> tuple:
        tree, pieces = item
        top = tops[tree]
        upper = top.nodes()
        none = np.zeros(plan.classes)
        upper.votes = votes_of(np.stack([none if r is None else r for r in top.rows]), plan.weights)
        parts, size = [upper], len(upper.cut)
        for small, nodes in sorted((p for p in pieces if p is not None), key=lambda p: p[0]):
            # The root of a piece takes the place of the small node; the rest of it comes behind what there is.
            move = np.concatenate([[small], size + np.arange(len(nodes.cut) - 1)]).astype(np.int32)
            upper.feature[small], upper.cut[small], upper.votes[small] = nodes.feature[0], nodes.cut[0], nodes.votes[0]
            upper.child[small] = move[nodes.child[0]]
            parts.append(Nodes(nodes.feature[1:], nodes.cut[1:], move[nodes.child[1:]], nodes.votes[1:]))
            size += len(nodes.cut) - 1
        whole = Nodes(*[np.concatenate([getattr(p, k) for p in parts]) for k in ("feature", "cut", "child", "votes")])
        return whole.pruned().to_row(tree)

    return run


def _lot(blocks, plan: Plan, features: int, trees: range, tasks: int):
    """The finished trees of a lot, grown from above."""
    tops = {tree: Top() for tree in trees}
    while True:
        still = {tree: top for tree, top in tops.items() if top.having("open")}
        if not still:
            break
        first = {tree: top.having("open")[0] for tree, top in still.items()}
        sums = blocks.mapPartitions(_open_sums(plan, still)).reduceByKey(np.add, min(len(still), tasks))
        for tree, found in sums.map(_open_splits(plan, features, first)).collect():
            tops[tree].settle(found, plan)
    numbers, levels, filled, task = {}, {}, 0, 0
    for tree, top in tops.items():
        for small in top.having("small"):
            rows = int(top.rows[small].sum())
            if filled and filled + rows > LOCAL_ROWS:
                task, filled = task + 1, 0
            filled += rows
            numbers[tree, small], levels[tree, small] = task, top.level[small]
    sent = blocks.flatMap(_to_pieces(plan, tops, numbers)).partitionBy(task + 1, int)
    pieces = sent.mapPartitions(_grown_pieces(plan, levels))
    # A tree without small nodes is whole already.
    all_trees = blocks.context.parallelize([(tree, None) for tree in trees], 1)
    return pieces.union(all_trees).groupByKey(min(len(trees), tasks)).map(_joined(plan, tops))


def fit_forest(
    df: DataFrame,
    features: list[str],
    label_index: str,
    weight: str,
    classes: int,
    trees: int,
    depth: int,
    seed: int = 42,
    bins: int = BINS,
) -> Forest:
    """Fit ``trees`` trees on all rows of ``df``. ``label_index`` has 0 .. classes - 1; all rows of a class have the same ``weight``.

    Each tree draws rows with repeats, each node tries the root of the number of features, and trees stop at ``depth``
    or where all rows of a node are of one class. Leaves of one split that say the same are merged.
    """
    spark = df.sparkSession
    edges = bin_edges(df, features, bins)
    found = {int(r[0]): r[1] for r in df.groupBy(label_index).agg(F.max(weight)).collect()}
    plan = Plan(
        seed,
        depth,
        int(np.ceil(np.sqrt(len(features)))),
        max(len(cuts) for cuts in edges.values()) + 2,
        np.array([found.get(k, 0.0) for k in range(classes)]),
    )
    placed = binned(df, edges).select(*[f"{f}_bin" for f in features], label_index, weight)
    stored = materialise(placed.mapInArrow(_packer(len(features)), _BLOCKS), "forest-blocks")
    rows = stored.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    blocks = stored.select("number", "size", "bins", "label").rdd.map(tuple)
    tasks = max(2 * spark.sparkContext.defaultParallelism, 16)
    path = scratch_path(spark, "forest-nodes")
    if rows <= LOCAL_ROWS:
        copies = min(trees, COPIES * max(spark.sparkContext.defaultParallelism, 4))
        sent = blocks.flatMap(lambda b: [(k, b) for k in range(copies)]).partitionBy(copies, int)
        spark.createDataFrame(sent.mapPartitions(_whole_trees(plan, trees, copies)), _NODES).write.parquet(path)
    else:
        blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)
        step = max(1, int(LOT_BYTES // (rows * (len(features) + 2))))
        try:
            for first in range(0, trees, step):
                lot = _lot(blocks, plan, len(features), range(first, min(first + step, trees)), tasks)
                spark.createDataFrame(lot, _NODES).write.mode("append").parquet(path)
                del lot
                # The files of a shuffle go with the object that stands for it.
                spark._jvm.System.gc()
        finally:
            blocks.unpersist()
    state = {"features": features, "edges": [edges[f] for f in features], "classes": classes}
    return Forest(state=json.dumps(state), nodes=path)


def _trees_in(path: str) -> Iterator[Nodes]:
    """The trees of a table, one by one."""
    from pyarrow import fs
    from pyarrow import parquet as pq

    if "://" not in path:
        path = "file://" + path.removeprefix("file:")
    system, place = fs.FileSystem.from_uri(path)
    for info in sorted(system.get_file_info(fs.FileSelector(place)), key=lambda i: i.path):
        if info.is_file and info.base_name.startswith("part-"):
            with system.open_input_file(info.path) as file:
                for batch in pq.ParquetFile(file).iter_batches(batch_size=1, columns=["feature", "cut", "child", "votes"]):
                    for row in zip(*[column.to_pylist() for column in batch.columns]):
                        yield Nodes.from_row(*row)


def votes(path: str, bins: np.ndarray, classes: int) -> np.ndarray:
    """Votes of all trees (rows, classes)."""
    total = np.zeros((bins.shape[1], classes), dtype=np.int64)
    for tree in _trees_in(path):
        total += tree.votes[tree.find(bins)]
    return total


class _Writer(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        self.sparkSession.read.parquet(self.instance.getOrDefault("nodes")).write.parquet(f"{path.rstrip('/')}/nodes")


class _Reader(DefaultParamsReader):
    def load(self, path: str) -> Forest:
        found = super().load(path)
        return found._set(nodes=f"{path.rstrip('/')}/nodes")


class Forest(Model, DefaultParamsReadable, DefaultParamsWritable):
    """The fitted model as a stage of a pipeline: adds ``prediction``, the index of the class with the most votes; ties go to the first.
    The trees stay in the folder ``nodes``, of which a saved model has a copy."""

    state = Param(Params._dummy(), "state", "features, edges and number of classes as JSON", TypeConverters.toString)
    nodes = Param(Params._dummy(), "nodes", "folder of the table of trees", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, state: str | None = None, nodes: str | None = None):
        super().__init__()
        if state is not None:
            self._set(state=state, nodes=nodes)

    def write(self) -> _Writer:
        return _Writer(self)

    @classmethod
    def read(cls) -> _Reader:
        return _Reader(cls)

    def size(self) -> int:
        """Nodes of all trees."""
        table = SparkSession.active().read.parquet(self.getOrDefault(self.nodes))
        return table.agg(F.coalesce(F.sum(F.length("cut")), F.lit(0))).first()[0]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        held, path = json.loads(self.getOrDefault(self.state)), self.getOrDefault(self.nodes)
        edges = [np.array(e) for e in held["edges"]]
        classes = held["classes"]

        def placed(columns) -> np.ndarray:
            values = [c.to_numpy(dtype=np.float64, na_value=np.nan) for c in columns]
            return np.stack(
                [np.where(np.isnan(v), len(e) + 1, np.searchsorted(e, v, side="right")).astype(np.uint8) for v, e in zip(values, edges)]
            )

        @F.pandas_udf("double")
        def scored(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            waiting, size = [], 0
            for columns in batches:
                # A single column comes without a tuple around it.
                waiting.append(placed(columns if isinstance(columns, tuple) else (columns,)))
                size += waiting[-1].shape[1]
                if size >= SCORE_ROWS:
                    yield pd.Series(votes(path, np.concatenate(waiting, axis=1), classes).argmax(axis=1).astype(np.float64))
                    waiting, size = [], 0
            if waiting:
                yield pd.Series(votes(path, np.concatenate(waiting, axis=1), classes).argmax(axis=1).astype(np.float64))

        return dataset.withColumn("prediction", scored(*[F.col(f).cast("double") for f in held["features"]]))
