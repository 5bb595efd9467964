"""Best-fit packing of documents into sequences of several permitted lengths."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyweave.llm.workspace import Workspace, numbered

SHARD_PIECES = 2_048
"""Pieces that are packed together, on average. A shard wastes at most a few sequences beyond a single global packing."""


@dataclass(frozen=True)
class Lengths:
    """Permitted sequence lengths and what a sequence costs: ``fixed + c + c * c / square``."""

    permitted: tuple[int, ...] = (256, 512, 1024, 2048, 4096)
    fixed: float = 64.0
    square: float = 16_384.0

    def cost(self, length: int) -> float:
        return self.fixed + length + length * length / self.square


def best_fit(sizes: np.ndarray, lengths: Lengths) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Bin and offset of each piece, and the final length of each bin.

    Pieces come in falling size. Each goes into the open bin with the least room that holds it. Where there is none, a bin is
    opened with the length that costs least for each token it can get: the piece and all pieces still to come are at most
    what fills it. At the end each bin is cut down to the shortest permitted length that holds its contents.
    """
    permitted = sorted(lengths.permitted)
    largest = permitted[-1]
    if len(sizes) and (sizes.max() > largest or sizes.min() < 1):
        raise ValueError(f"sizes must be from 1 to {largest}")
    order = np.argsort(-sizes, kind="stable")
    left = int(sizes.sum())
    bins, offsets = np.zeros(len(sizes), dtype=np.int64), np.zeros(len(sizes), dtype=np.int64)
    room: list[int] = []
    used: list[int] = []
    by_room: list[list[int]] = [[] for _ in range(largest + 1)]
    present = 0
    for i in order.tolist():
        size = int(sizes[i])
        fitting = present >> size
        if fitting:
            at = size + (fitting & -fitting).bit_length() - 1
            b = by_room[at].pop()
            if not by_room[at]:
                present &= ~(1 << at)
        else:
            length = min((c for c in permitted if c >= size), key=lambda c: (lengths.cost(c) / min(c, left), c))
            b = len(room)
            room.append(length)
            used.append(0)
        bins[i], offsets[i] = b, used[b]
        used[b] += size
        room[b] -= size
        left -= size
        if room[b]:
            by_room[room[b]].append(b)
            present |= 1 << room[b]
    final = [next(c for c in permitted if c >= u) for u in used]
    return bins, offsets, final


_PACKED = "doc_id long, row_id long, piece int, start long, length long, bin_id long, capacity int, offset long"


def _packer(lengths: Lengths):
    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("row_id", "ascending"), ("piece", "ascending")])
        bins, offsets, final = best_fit(table.column("length").to_numpy(), lengths)
        shard = int(table.column("shard")[0].as_py())
        columns = [table.column(c) for c in ("doc_id", "row_id", "piece", "start", "length")]
        columns += [
            pa.array(bins + (shard << 32), pa.int64()),
            pa.array(np.array(final, dtype=np.int32)[bins]),
            pa.array(offsets, pa.int64()),
        ]
        names = ["doc_id", "row_id", "piece", "start", "length", "bin_id", "capacity", "offset"]
        return pa.Table.from_arrays(columns, names=names)

    return pack


def packed(sizes: DataFrame, workspace: Workspace, lengths: Lengths = Lengths(), shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """A row per piece of every row of ``sizes`` (``doc_id``, ``size`` in tokens): doc_id, row_id, piece, start, length, bin_id,
    capacity, offset.

    Documents longer than the longest permitted length are cut into pieces of that length and a rest; nothing is
    truncated. Rows of size 0 or null are one piece of length 0 in no bin. Pieces are dealt to shards of a bounded size by
    a hash of the row number, so no key gathers them, and each shard is packed by itself. Repeated rows are
    packed each; an empty table gives an empty result; null ids stay null; other columns are not looked at.
    """
    top = max(lengths.permitted)
    rows = workspace.keep(
        numbered(sizes.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("size", F.lit(0)).cast("long").alias("size"))),
        "sizes",
    )
    cuts = F.when(F.col("size") > 0, F.ceil(F.col("size") / top).cast("int")).otherwise(F.lit(1))
    count = rows.agg(F.coalesce(F.sum(cuts), F.lit(0)).alias("n")).first().n
    shards = max(1, -(-count // shard_pieces))
    pieces = (
        rows.withColumn("piece", F.explode(F.sequence(F.lit(0), cuts - 1)))
        .withColumn("start", F.col("piece").cast("long") * top)
        .withColumn("length", F.least(F.col("size") - F.col("start"), F.lit(top).cast("long")))
        .withColumn("shard", F.pmod(F.xxhash64("row_id", "piece"), F.lit(shards)))
        .select("doc_id", "row_id", "piece", "start", "length", "shard")
    )
    pack = _packer(lengths)
    filled = pieces.where("length > 0").groupBy("shard").applyInArrow(lambda t: pack(t), _PACKED)
    nothing = pieces.where("length <= 0").select(
        "doc_id", "row_id", "piece", "start", "length",
        F.lit(None).cast("long").alias("bin_id"), F.lit(None).cast("int").alias("capacity"), F.lit(0).cast("long").alias("offset"),
    )
    return filled.unionByName(nothing)
