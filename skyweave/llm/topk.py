"""Exact top-k inner-product search by pruning blocks of a document range."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyweave.llm.workspace import Workspace

BLOCK_ROWS = 256
"""Vectors in a block: one forward index, one pair of maxima and minima for each term."""

CELL_ROWS = 65_536
"""Most vectors that meet in a cell of the grid, on either side."""

_PACKED = "group int, ids binary, values binary, width int"


def quantised(df: DataFrame, id_col: str, vector_col: str, scale: float = 64.0) -> DataFrame:
    """``id`` and integer components floor(scale * x), without vectors that are null or hold null, NaN or infinity."""
    usable = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return df.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & usable).select(
        F.col(id_col).cast("long").alias("id"),
        F.transform(vector_col, lambda x: F.floor(F.lit(scale) * x.cast("double"))).alias("terms"),
    )


def _packer(rows: int, groups: int):
    """Packs consecutive vectors of a partition to blocks; blocks are dealt to the groups in turn."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId()
        ids, vectors = [], []

        def block():
            nonlocal number
            width = max(map(len, vectors))
            body = np.zeros((len(vectors), width), dtype=np.int64)
            for i, v in enumerate(vectors):
                body[i, : len(v)] = v
            out = pa.RecordBatch.from_pydict(
                {
                    "group": pa.array([number % groups], pa.int32()),
                    "ids": [np.array(ids, dtype=np.int64).tobytes()],
                    "values": [_shrunk(body).tobytes()],
                    "width": pa.array([width], pa.int32()),
                }
            )
            number += 1
            ids.clear()
            vectors.clear()
            return out

        for batch in batches:
            keys = batch.column(0).to_pylist()
            lists = batch.column(1)
            offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            for i, key in enumerate(keys):
                ids.append(key)
                vectors.append(flat[offsets[i] : offsets[i + 1]])
                if len(ids) >= rows:
                    yield block()
        if ids:
            yield block()

    return pack


def _shrunk(body: np.ndarray) -> np.ndarray:
    return body.astype(np.int16) if body.size == 0 or np.abs(body).max() < 32_768 else body


def _opened(ids: bytes, values: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    keys = np.frombuffer(ids, dtype=np.int64)
    kind = np.int16 if len(values) == 2 * width * len(keys) else np.int64
    return keys, np.frombuffer(values, dtype=kind).reshape(len(keys), width).astype(np.int64)


def _stacked(tables: list[tuple[np.ndarray, np.ndarray]], width: int) -> np.ndarray:
    return np.concatenate([np.pad(v, ((0, 0), (0, width - v.shape[1]))) for _, v in tables])


def search_cell(
    queries: list[tuple[np.ndarray, np.ndarray]], blocks: list[tuple[np.ndarray, np.ndarray]], k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best vectors of ``blocks`` for each query: query ids, vector ids and scores, up to k rows each.

    The bound of a block is the sum over all terms of the largest product any vector of the block can have. A query
    takes its blocks in falling order of the bound and stops below its k-th score; equal bounds are still scored,
    since a tie may be won by a smaller id.
    """
    width = max(v.shape[1] for _, v in [*queries, *blocks])
    qid = np.concatenate([i for i, _ in queries])
    q = _stacked(queries, width)
    index = [np.pad(v, ((0, 0), (0, width - v.shape[1]))) for _, v in blocks]
    most = float(np.abs(q).max(initial=0)) * max(float(np.abs(b).max(initial=0)) for b in index) * max(width, 1)
    kind = np.float64 if most < 2**52 else np.int64
    q, index = q.astype(kind), [b.astype(kind) for b in index]
    high, low = np.stack([b.max(axis=0) for b in index]), np.stack([b.min(axis=0) for b in index])
    bound = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
    order = np.argsort(-bound, axis=1, kind="stable")
    worst = -(2**62)
    score = np.full((len(q), k), worst, dtype=np.int64)
    found = np.full((len(q), k), 2**62, dtype=np.int64)
    for turn in range(len(index)):
        block_of = order[:, turn]
        alive = np.flatnonzero((bound[np.arange(len(q)), block_of] >= score[:, -1]) | (score[:, -1] == worst))
        if not len(alive):
            break
        alive = alive[np.argsort(block_of[alive], kind="stable")]
        for rows in np.split(alive, np.flatnonzero(np.diff(block_of[alive])) + 1):
            b = block_of[rows[0]]
            ids = blocks[b][0]
            products = (q[rows] @ index[b].T).astype(np.int64)
            products[ids[None, :] == qid[rows][:, None]] = worst
            useful = np.flatnonzero((products >= score[rows, -1][:, None]).any(axis=1))
            rows, products = rows[useful], products[useful]
            all_scores = np.concatenate((score[rows], products), axis=1)
            all_ids = np.concatenate((found[rows], np.broadcast_to(ids, products.shape)), axis=1)
            all_ids = np.where(all_scores == worst, 2**62, all_ids)
            best = np.lexsort((all_ids, -all_scores), axis=1)[:, :k]
            score[rows] = np.take_along_axis(all_scores, best, axis=1)
            found[rows] = np.take_along_axis(all_ids, best, axis=1)
    real = score != worst
    return np.repeat(qid, real.sum(axis=1)), found[real], score[real]


def _searcher(k: int):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        sides = []
        for table in (left, right):
            parts = [table.column(n).to_pylist() for n in ("ids", "values", "width")]
            sides.append([_opened(*x) for x in zip(*parts)])
        if not sides[0] or not sides[1]:
            return schema.empty_table()
        step = max(1, 2048 // max(len(i) for i, _ in sides[0]))
        out = [search_cell(sides[0][i : i + step], sides[1], k) for i in range(0, len(sides[0]), step)]
        return pa.table([np.concatenate(c) for c in zip(*out)], schema=schema)

    return search


def top_k(
    queries: DataFrame,
    vectors: DataFrame,
    k: int,
    workspace: Workspace,
    block_rows: int = BLOCK_ROWS,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """Each query's k highest inner products over all vectors but those with the query's id: query_id, rank, vec_id,
    score; ties go to the smaller id.

    Both inputs have ``id`` and integer ``terms`` (``quantised``). Vectors are packed to blocks along the order
    of their strongest term, so that a block's maxima stay close to its members. Blocks and query batches form a grid:
    a cell holds at most about ``cell_rows`` vectors and queries, whatever the size of the input, and returns k rows for
    each query; the best of all cells are then taken. Missing components count as zero. Rows with equal ids are
    all ranked, but none for a query with that id. Queries without any other vector have no row; empty inputs give an
    empty result.
    """
    spread = F.transform("terms", lambda x: F.abs(x))
    kept = workspace.keep(
        vectors.withColumn("place", F.coalesce(F.array_position(spread, F.array_max(spread)), F.lit(0))), "vectors"
    )
    asked = workspace.keep(queries, "queries")
    n, m = kept.count(), asked.count()
    wide, tall = max(1, -(-n // cell_rows), min(12, n // 2048)), max(1, -(-m // cell_rows), min(2, m // 1024))
    parts = max(wide, -(-n // (64 * block_rows)))
    blocks = (
        kept.repartitionByRange(parts, "place", "id")
        .sortWithinPartitions("place", "id")
        .select("id", "terms")
        .mapInArrow(_packer(block_rows, wide), _PACKED)
    )
    batches = (
        asked.repartitionByRange(max(tall, -(-m // (64 * block_rows))), "id")
        .select("id", "terms")
        .mapInArrow(_packer(block_rows, tall), _PACKED)
    )
    on_grid = batches.withColumnRenamed("group", "down").withColumn(
        "cell", F.explode(F.transform(F.sequence(F.lit(0), F.lit(wide - 1)), lambda g: g * tall + F.col("down")))
    )
    of_grid = blocks.withColumn(
        "cell", F.explode(F.transform(F.sequence(F.lit(0), F.lit(tall - 1)), lambda g: F.col("group") * tall + g))
    )
    columns = ["cell", "ids", "values", "width"]
    cells = workspace.keep(
        on_grid.select(*columns)
        .groupBy("cell")
        .cogroup(of_grid.select(*columns).groupBy("cell"))
        .applyInArrow(lambda a, b: _searcher(k)(a, b), "query_id long, vec_id long, score long"),
        "cells",
    )
    from pyspark.sql import Window

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        cells.withColumn("rank", F.row_number().over(order).cast(T.IntegerType()))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
