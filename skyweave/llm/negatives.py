"""Hard negatives by one-bit codes with intervals that cannot miss.

A vector r, rotated, is kept as the signs of its components and its alignment a = <r, b> with the unit vector b of these signs;
what the signs leave of r is coded again, ``LEVELS`` times. For an anchor s the estimate is the sum of a * <b, s>, where <b, s>
comes from popcounts of the signs against bit planes of s. The rest e of r is orthogonal to the last b, so by
Cauchy-Schwarz |<e, s>| is at most |e| times the length of the part of s orthogonal to b. These intervals always hold the score:
only candidates whose interval meets what is asked are scored, in integers.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyweave.llm.workspace import Workspace, numbered

LEVELS = 4
"""One-bit codes kept for each vector: the first is tested on all pairs, each further one on the pairs left."""

PLANES = 8
"""Bits of an anchor's components in the popcounts."""

BLOCK_ROWS = 4096
CELL_BYTES = 48 << 20
"""Most bytes of vectors and codes, and of anchors, that meet in a cell of the grid."""

_U = np.uint64
_PACKED = "group int, size int, ids binary, labels binary, values binary, codes binary, aligned binary, rests binary"


@lru_cache(maxsize=4)
def rotation(width: int) -> np.ndarray:
    """The same random orthogonal matrix in every task."""
    q, r = np.linalg.qr(np.random.Generator(np.random.PCG64(2024)).standard_normal((width, width)))
    return q * np.sign(np.diag(r))


def _bits(signs: np.ndarray) -> np.ndarray:
    """Rows of booleans to rows of 64-bit words."""
    rows, width = signs.shape
    padded = np.zeros((rows, -(-width // 64) * 64), dtype=bool)
    padded[:, :width] = signs
    return np.packbits(padded, axis=1, bitorder="little").view(np.uint64)


def encoded(values: np.ndarray, levels: int = LEVELS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (rows, levels, words), alignments (rows, levels) and lengths of what each level leaves (rows, levels)."""
    rest = values.astype(np.float64) @ rotation(values.shape[1])
    codes, aligned, rests = [], [], []
    unit = 1.0 / np.sqrt(max(values.shape[1], 1))
    for _ in range(levels):
        signs = rest >= 0
        b = np.where(signs, unit, -unit)
        a = (rest * b).sum(axis=1)
        rest = rest - a[:, None] * b
        codes.append(_bits(signs))
        aligned.append(a)
        rests.append(np.sqrt((rest * rest).sum(axis=1)))
    return np.stack(codes, axis=1), np.stack(aligned, axis=1), np.stack(rests, axis=1)


class Anchor:
    """An anchor's rotated components as bit planes."""

    def __init__(self, values: np.ndarray, planes: int = PLANES):
        self.values = values.astype(np.int64)
        s = self.values.astype(np.float64) @ rotation(len(values))
        self.length = float(np.sqrt((s * s).sum()))
        self.low = float(s.min(initial=0))
        self.step = max((float(s.max(initial=0)) - self.low) / (2**planes - 1), 1e-12)
        steps = np.rint((s - self.low) / self.step)
        approx = self.low + steps * self.step
        self.unit = 1.0 / np.sqrt(max(len(values), 1))
        self.total = float(approx.sum())
        self.error = float(np.abs(s - approx).sum()) * self.unit
        self.planes = _bits((steps.astype(np.int64)[None, :] >> np.arange(planes)[:, None] & 1).astype(bool))

    def projected(self, codes: np.ndarray) -> np.ndarray:
        """<b, s> of each code, within ``error``."""
        inside = self.low * np.bitwise_count(codes).sum(axis=-1, dtype=np.int64)
        for j, plane in enumerate(self.planes):
            inside = inside + self.step * 2.0**j * np.bitwise_count(codes & plane).sum(axis=-1, dtype=np.int64)
        return (2.0 * inside - self.total) * self.unit


class Block:
    """Vectors of a cell with their codes."""

    def __init__(self, ids, labels, values, codes, aligned, rests):
        self.ids, self.labels, self.values = ids, labels, values
        self.codes, self.aligned, self.rests = codes, aligned, rests

    def intervals(self, anchor: Anchor, level: int, rows: np.ndarray, estimate: np.ndarray):
        """Adds a level to the estimates of ``rows``; the new estimates and the half-widths of their intervals."""
        g = anchor.projected(self.codes[rows, level])
        estimate = estimate + self.aligned[rows, level] * g
        beside = np.maximum(np.abs(g) - anchor.error, 0.0)
        across = np.sqrt(np.maximum(anchor.length**2 - beside * beside, 0.0))
        coded = np.abs(self.aligned[rows, : level + 1]).sum(axis=1)
        # The last term covers the rounding of the floating-point steps.
        slack = 1e-9 * anchor.length * (coded + self.rests[rows, level]) + 1e-3
        return estimate, coded * anchor.error + self.rests[rows, level] * across + slack


def _kth(lower: np.ndarray, k: int) -> float:
    return -np.inf if len(lower) < k else float(np.partition(lower, len(lower) - k)[len(lower) - k])


def candidates(anchor: Anchor, block: Block, rows: np.ndarray, bands: list[tuple[float, float]], k: int) -> np.ndarray:
    """Those of ``rows`` that may be among the k best of a band (low, high).

    A row stays while its interval meets a band and reaches the k-th best lower end of the rows that are in the band
    for certain; each level is tested on the rows the one before has left.
    """
    estimate = np.zeros(len(rows))
    for level in range(block.codes.shape[1]):
        estimate, half = block.intervals(anchor, level, rows, estimate)
        lower, upper = estimate - half, estimate + half
        alive = np.zeros(len(rows), dtype=bool)
        for low, high in bands:
            certain = (lower >= low) & (upper <= high)
            alive |= (upper >= max(low, _kth(lower[certain], k))) & (lower <= high)
        rows, estimate = rows[alive], estimate[alive]
    return rows


def best_in_bands(
    anchor: Anchor, block: Block, rows: np.ndarray, bands: list[tuple[float, float]], k: int
) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each band (low, high) the k best of ``rows`` whose score is in it: ids and scores, ties to the smaller id."""
    rows = candidates(anchor, block, rows, bands, k)
    scores = block.values[rows].astype(np.int64) @ anchor.values
    out = []
    for low, high in bands:
        inside = np.flatnonzero((scores >= low) & (scores <= high))
        best = inside[np.lexsort((block.ids[rows[inside]], -scores[inside]))[:k]]
        out.append((block.ids[rows[best]], scores[best]))
    return out


def _packer(rows: int, groups: int, width: int):
    """Packs consecutive vectors (id, label, terms) of a partition to blocks; blocks are dealt to the groups in turn."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId()
        ids, labels, vectors = [], [], []

        def block():
            nonlocal number
            body = np.zeros((len(vectors), width), dtype=np.int64)
            for i, v in enumerate(vectors):
                body[i, : len(v)] = v
            codes, aligned, rests = encoded(body)
            if np.abs(body).max(initial=0) < 32_768:
                body = body.astype(np.int16)
            parts = [np.array(ids, dtype=np.int64), np.array(labels, dtype=np.int64), body, codes, aligned, rests]
            out = pa.RecordBatch.from_arrays(
                [pa.array([number % groups], pa.int32()), pa.array([len(ids)], pa.int32())]
                + [pa.array([p.tobytes()], pa.binary()) for p in parts],
                names=[c.split()[0] for c in _PACKED.split(", ")],
            )
            number += 1
            for held in (ids, labels, vectors):
                held.clear()
            return out

        for batch in batches:
            keys, classes, lists = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)
            offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            for i, key in enumerate(keys):
                ids.append(key)
                labels.append(classes[i])
                vectors.append(flat[offsets[i] : offsets[i + 1]])
                if len(ids) >= rows:
                    yield block()
        if ids:
            yield block()

    return pack


def _opened(table: pa.Table, width: int) -> Block:
    """All blocks of a table as one."""
    parts = []
    for row in table.to_pylist():
        n = row["size"]
        kind = np.int16 if len(row["values"]) == 2 * n * width else np.int64
        parts.append(
            (
                np.frombuffer(row["ids"], dtype=np.int64),
                np.frombuffer(row["labels"], dtype=np.int64),
                np.frombuffer(row["values"], dtype=kind).reshape(n, width),
                np.frombuffer(row["codes"], dtype=np.uint64).reshape(n, LEVELS, -1),
                np.frombuffer(row["aligned"]).reshape(n, LEVELS),
                np.frombuffer(row["rests"]).reshape(n, LEVELS),
            )
        )
    return Block(*[np.concatenate(c) for c in zip(*parts)])


_FOUND = "anchor long, place int, vec_id long, score long"


def _rows(found: list[tuple]) -> pa.Table:
    schema = pa.schema([("anchor", pa.int64()), ("place", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())])
    if not found:
        return schema.empty_table()
    sizes = [len(ids) for _, _, ids, _ in found]
    return pa.table(
        [
            np.repeat([f[0] for f in found], sizes).astype(np.int64),
            np.repeat([f[1] for f in found], sizes).astype(np.int32),
            np.concatenate([f[2] for f in found]),
            np.concatenate([f[3] for f in found]),
        ],
        schema=schema,
    )


def _own_label(k: int, width: int):
    """A cell of the first pass: the k best rows of an anchor's label."""

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _rows([])
        block, found = _opened(right, width), []
        of_label = {label: np.flatnonzero(block.labels == label) for label in np.unique(block.labels)}
        for row in left.to_pylist():
            rows = of_label.get(row["label"], np.empty(0, dtype=np.int64))
            rows = rows[block.ids[rows] != row["id"]]
            anchor = Anchor(_padded(row["terms"], width))
            ((ids, scores),) = best_in_bands(anchor, block, rows, [(-np.inf, np.inf)], k)
            found.append((row["anchor"], 0, ids, scores))
        return _rows(found)

    return search


def _other_labels(k: int, share: int, width: int):
    """A cell of the second pass: the k best rows of other labels in the band of each positive."""

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _rows([])
        block, found = _opened(right, width), []
        others = {label: np.flatnonzero(block.labels != label) for label in np.unique(block.labels)}
        everything = np.arange(len(block.ids))
        for row in left.to_pylist():
            rows = others.get(row["label"], everything)
            # Scores are whole numbers, so the lower end of a band is one, too; of a negative score the band is empty.
            bands = [(-(-share * s // 100), s) for s in row["scores"]]
            anchor = Anchor(_padded(row["terms"], width))
            for place, (ids, scores) in enumerate(best_in_bands(anchor, block, rows, bands, k), start=1):
                found.append((row["anchor"], place, ids, scores))
        return _rows(found)

    return search


def _padded(terms: list[int], width: int) -> np.ndarray:
    return np.array(terms + [0] * (width - len(terms)), dtype=np.int64)


def _spread(df: DataFrame, column: str, count: int, cell: Column) -> DataFrame:
    """Each row once for every group of the other side."""
    return df.withColumn(column, F.explode(F.sequence(F.lit(0), F.lit(count - 1)))).withColumn("cell", cell)


def labelled_vectors(df: DataFrame, id_col: str, vector_col: str, label: Column, scale: float = 256.0) -> DataFrame:
    """``id``, ``label`` and integer ``terms`` floor(scale * x), without rows whose id or label is null or whose vector is null
    or holds null, NaN or infinity."""
    usable = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    held = df.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        label.cast("long").alias("label"),
        F.col(f"`{vector_col}`").alias("vector"),
    )
    kept = held.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & usable)
    return kept.select("id", "label", F.transform("vector", lambda x: F.floor(F.lit(scale) * x.cast("double"))).alias("terms"))


def hard_negatives(
    anchors: DataFrame,
    vectors: DataFrame,
    workspace: Workspace,
    positives: int = 5,
    negatives: int = 5,
    share: int = 80,
    cell_bytes: int = CELL_BYTES,
) -> DataFrame:
    """For each anchor and positive the best rows of other labels that score from ``share`` percent of the positive's score up to it:
    anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Both inputs have ``id``, ``label`` and integer ``terms`` (``labelled_vectors``); scores are inner products and must fit 64 bits.
    Positives are the ``positives`` best other rows of the anchor's label. Higher scores come first, ties by smaller id. A row is another
    one if its id is; rows with equal ids are all ranked, and an anchor row that occurs twice answers twice. Missing components
    count as zero. Anchors without a positive, positives without a negative and empty inputs have no rows; a negative
    positive score leaves an empty range.

    Anchors and blocks of vectors form a grid of cells bounded by ``cell_bytes`` on either side, however many rows a label
    has. The first pass finds the positives, the second the negatives; a cell returns at most ``negatives`` rows for each
    positive and the best of all cells are taken.
    """
    spark = vectors.sparkSession
    kept = workspace.keep(vectors.select("id", "label", "terms"), "vectors")
    asked = workspace.keep(numbered(anchors.select("id", "label", "terms"), "anchor"), "anchors")
    n, width = kept.agg(F.count("*"), F.coalesce(F.max(F.size("terms")), F.lit(0))).first()
    m = asked.count()
    width = max(width, asked.agg(F.coalesce(F.max(F.size("terms")), F.lit(0))).first()[0], 1)
    row_bytes = 8 * width + LEVELS * (width // 8 + 24) + 16
    cell_rows = max(1, cell_bytes // row_bytes)
    wide = max(1, -(-n // cell_rows), min(12, n // 2048))
    tall = max(1, -(-m // cell_rows), min(4, m // 256))
    block_rows = max(1, min(BLOCK_ROWS, cell_rows, -(-n // wide)))
    blocks = workspace.keep(
        kept.repartition(max(wide, -(-n // (16 * block_rows))), "id", "terms")
        .mapInArrow(_packer(block_rows, wide, width), _PACKED),
        "blocks",
    )
    of_grid = _spread(blocks, "down", tall, F.col("group") * tall + F.col("down")).drop("group", "down")

    def searched(side: DataFrame, search) -> DataFrame:
        down = F.pmod(F.xxhash64("anchor"), F.lit(tall)).cast("int")
        on_grid = _spread(side, "across", wide, F.col("across") * tall + down).drop("across")
        return on_grid.groupBy("cell").cogroup(of_grid.groupBy("cell")).applyInArrow(lambda a, b: search(a, b), _FOUND)

    def best(found: DataFrame, k: int) -> DataFrame:
        order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order).cast(T.IntegerType())).where(F.col("rank") <= k)

    if n == 0 or m == 0:
        nothing = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        return spark.createDataFrame([], nothing)
    near = workspace.keep(best(searched(asked, _own_label(positives, width)), positives), "positives")
    ladder = near.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("near"))
    held = workspace.keep(asked.join(ladder, "anchor"), "ladders")
    bands = held.select("anchor", "label", "terms", F.transform("near", lambda p: p["score"]).alias("scores"))
    far = workspace.keep(best(searched(bands, _other_labels(negatives, share, width)), negatives), "negatives")
    place = F.posexplode("near").alias("p", "positive")
    pairs = held.select("anchor", F.col("id").alias("anchor_id"), place).withColumn("place", F.col("p") + 1)
    return far.join(pairs, ["anchor", "place"]).select(
        "anchor_id",
        F.col("positive.vec_id").alias("positive_id"),
        "rank",
        F.col("vec_id").alias("negative_id"),
        F.col("positive.score").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
