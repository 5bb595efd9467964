"""Quality rules: measures of single documents, and lines that many documents of a host share."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyweave.llm.tokens import chunks, words
from skyweave.llm.workspace import Workspace

WINDOW = 5

# The symbols that count, and the base limits.
SYMBOLS = b"#*$%&|<>"
LEAST_WORDS = 10
REPEAT_PERCENT = 20


@dataclass(frozen=True)
class LineLimits:
    """When a line is boilerplate of its host, and when a document without its boilerplate is depleted."""

    documents: int = 100
    """A line in more distinct documents of a host than this ..."""
    share: float = 0.01
    """... and in more than this share of the host's distinct documents is removed, ..."""
    always: int | None = None
    """... and so is one in more distinct documents than this, whatever the size of the host."""
    left_words: int = 5
    """A document of which fewer words than this are left is depleted, ..."""
    left_share: float = 0.1
    """... and so is one of which less than this share of its words is left."""


HOST_LIMITS = LineLimits(documents=5, share=0.01, always=100)
"""The limits of the registered query and the pipeline: they follow the host, from a few documents up to a fixed number."""


_MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, copy long"


def _measured(column: pa.Array) -> dict[str, np.ndarray]:
    """The measures of a chunk of texts."""
    found = words(column)
    rows, counts, h = found.rows, found.counts(), found.hashes()
    lead = (found.data & 0xC0) != 0x80
    running = np.concatenate(([0], np.cumsum(lead)))
    word_chars = np.bincount(found.row, weights=running[found.end] - running[found.start], minlength=rows)
    symbol = np.isin(found.data, np.frombuffer(SYMBOLS, dtype=np.uint8))
    total = np.concatenate(([0], np.cumsum(symbol)))
    n_symbols = total[found.offsets[1:]] - total[found.offsets[:-1]]
    repeated = np.zeros(rows, dtype=np.int64)
    if len(h):
        first = np.cumsum(counts) - counts
        at = np.flatnonzero(np.arange(len(h)) + WINDOW - first[found.row] <= counts[found.row])
        value = np.zeros(len(at), dtype=np.uint64)
        for j in range(WINDOW):
            value = value * np.uint64(0x9E3779B97F4A7C15) + (h[at + j] ^ (h[at + j] >> np.uint64(29)))
        covered = np.zeros(len(h) + WINDOW, dtype=bool)
        bounds = np.searchsorted(found.row[at], np.arange(rows + 1))
        for r in np.flatnonzero(np.diff(bounds) > 1):
            part = value[bounds[r] : bounds[r + 1]]
            order = np.argsort(part, kind="stable")
            same = part[order][1:] == part[order][:-1]
            twice = np.concatenate((same, [False])) | np.concatenate(([False], same))
            covered[at[bounds[r] : bounds[r + 1]][order[twice]]] = True
        spread = covered.copy()
        for j in range(1, WINDOW):
            spread[j:] |= covered[:-j]
        repeated = np.bincount(found.row, weights=spread[: len(h)], minlength=rows).astype(np.int64)
    return {
        "n_words": counts,
        "word_chars": word_chars.astype(np.int64),
        "n_symbols": n_symbols,
        "n_repeat_words": repeated,
    }


def _lines(text: str) -> tuple[list[str], list[int], int]:
    """The text's lines with a word, normalised, the words of each, and how many equal an earlier line."""
    exact, kept, sizes, again = set(), [], [], 0
    for line in text.split("\n"):
        parts = line.encode().split()
        if not parts:
            continue
        if line in exact:
            again += 1
        exact.add(line)
        kept.append(b" ".join(parts).lower())
        sizes.append(len(parts))
    return kept, sizes, again


def _measurer():
    import hashlib

    schema = pa.schema(
        [(n, pa.int64()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "copy")]
    )
    pair = pa.list_(pa.struct([("line", pa.int64()), ("size", pa.int32())]))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            texts = batch.column("text").fill_null("")
            for at, part in chunks(texts):
                known = _measured(part)
                again, lines, copies = [], [], []
                for text in part.to_pylist():
                    kept, sizes, twice = _lines(text)
                    again.append(twice)
                    digests = b"".join(hashlib.blake2b(x, digest_size=8).digest() for x in kept)
                    copies.append(hashlib.blake2b(digests, digest_size=8).digest())
                    hashes = np.frombuffer(digests, dtype=np.int64)
                    distinct, where = np.unique(hashes, return_inverse=True)
                    total = np.bincount(where, weights=sizes, minlength=len(distinct)).astype(np.int32)
                    lines.append([{"line": int(a), "size": int(b)} for a, b in zip(distinct, total)])
                known["n_dup_lines"] = np.array(again, dtype=np.int64)
                known["copy"] = np.frombuffer(b"".join(copies), dtype=np.int64)
                columns = [batch.column("host").slice(at, len(part))]
                columns += [pa.array(known[f.name], pa.int64()) for f in schema]
                columns += [pa.array(lines, pair), pa.array(number + np.arange(len(part)), pa.int64())]
                number += len(part)
                extra = [batch.column(i).slice(at, len(part)) for i in range(2, batch.num_columns)]
                names = ["host", *schema.names, "lines", "row_id", *batch.schema.names[2:]]
                yield pa.RecordBatch.from_arrays([*columns, *extra], names=names)

    return measure


def measured(docs: DataFrame, host_col: str, kept_cols: list[str], workspace: Workspace, prefix: str = "in_") -> DataFrame:
    """A row per document with the base measures, its distinct lines and a row number; ``kept_cols`` come along
    under ``prefix``. Written to the workspace, which fixes the row numbers."""
    extra = [F.col(f"`{c}`").alias(f"{prefix}{c}") for c in kept_cols]
    source = docs.select(F.col("text"), F.col(host_col).cast("string").alias("host"), *extra)
    types = ", ".join(f"`{prefix}{c}` {docs.schema[c].dataType.simpleString()}" for c in kept_cols)
    fields = (
        "host string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "copy long, lines array<struct<line: long, size: int>>, row_id long"
    )
    return workspace.keep(source.mapInArrow(_measurer(), fields + (f", {types}" if types else "")), "measured")


def judged(rows: DataFrame, limits: LineLimits, workspace: Workspace) -> DataFrame:
    """``rows`` of ``measured`` with ``base_failed``, ``removed_words``, ``kept``, and the hashes of removed lines.

    A line counts once for each distinct document of a host: documents whose normalised lines are all the same, in the
    same order, are copies and count as one, so that copies alone don't make their text boilerplate. Counts are aggregated
    before they are shuffled; the few lines above the limits are written and joined back by line, and per document by its
    row number.
    """
    removed = _removed(rows, limits, workspace)
    return (
        rows.join(removed, "row_id", "left")
        .withColumn("removed_words", F.coalesce("removed_words", F.lit(0)))
        .withColumn("base_failed", _failed())
        .withColumn("kept", ~_failed() & ~_depleted(limits))
    )


def _failed():
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def _depleted(limits: LineLimits):
    left = F.col("n_words") - F.col("removed_words")
    return (F.col("removed_words") > 0) & ((left < limits.left_words) | (left < F.col("n_words") * limits.left_share))


def _removed(rows: DataFrame, limits: LineLimits, workspace: Workspace) -> DataFrame:
    """``row_id``, ``removed_words`` and ``removed_lines`` of the documents that have lines above the limits."""
    host = F.coalesce("host", F.lit("")), F.col("host").isNull()
    lines = rows.select(
        F.xxhash64(*host).alias("site"), "copy", "row_id", F.explode("lines").alias("x")
    ).select("site", "copy", "row_id", "x.line", "x.size")
    sites = (
        rows.select(F.xxhash64(*host).alias("site"), "copy").distinct().groupBy("site").agg(F.count("*").alias("documents"))
    )
    wide = F.col("times") > F.col("documents") * limits.share
    if limits.always is not None:
        wide = wide | (F.col("times") > limits.always)
    frequent = (
        lines.groupBy("site", "line", "copy").agg(F.lit(1).alias("one"))
        .groupBy("site", "line").agg(F.count("*").alias("times"))
        .where(F.col("times") > limits.documents)
        .join(sites, "site")
        .where(wide)
        .select("site", "line", "times")
    )
    frequent = workspace.keep(frequent, "frequent")
    return (
        lines.join(frequent, ["site", "line"])
        .groupBy("row_id")
        .agg(F.sum("size").alias("removed_words"), F.collect_list("line").alias("removed_lines"))
    )


def quality(docs: DataFrame, workspace: Workspace, host_col: str = "source", limits: LineLimits = LineLimits()) -> DataFrame:
    """Every row of ``docs`` with measures and verdict; input columns come back under the prefix ``in_``.

    Words are runs of other bytes than space and the controls 9 to 13. Null and empty texts have no words and fail.
    Null hosts are one host of their own. Repeated rows are judged alike, each on its own row; an empty table
    gives an empty result. Columns of any name pass through.
    """
    return judged(measured(docs, host_col, docs.columns, workspace), limits, workspace)


def filtered(docs: DataFrame, workspace: Workspace, host_col: str = "source", limits: LineLimits = LineLimits()) -> DataFrame:
    """The kept rows of ``docs`` with their own columns, their texts without the lines above the limits; ``n_chars``, if
    there, follows the text.

    The documents with such lines are written first, by number and line hashes: texts are joined to them, and moved only
    if the list is too long for Spark to broadcast.
    """
    rows = measured(docs, host_col, docs.columns, workspace)
    removed = workspace.keep(_removed(rows, limits, workspace), "removed")
    found = rows.where(~_failed()).join(removed, "row_id", "left").withColumn("removed_words", F.coalesce("removed_words", F.lit(0)))
    touched = F.col("removed_lines").isNotNull()
    # Only texts with lines to remove go through Python.
    clean = without_lines(F.when(touched, F.col("in_text")), F.col("removed_lines"))
    found = found.where(~_depleted(limits)).withColumn("in_text", F.coalesce(clean, F.col("in_text")))
    if "n_chars" in docs.columns:
        size = F.length("in_text").cast(docs.schema["n_chars"].dataType)
        found = found.withColumn("in_n_chars", F.when(touched, size).otherwise(F.col("in_n_chars")))
    return found.select(*[F.col(f"`in_{c}`").alias(c) for c in docs.columns])


def without_lines(text, removed):
    """``text`` (column) without the lines whose hashes stand in ``removed``."""

    @F.pandas_udf("string")
    def clean(texts, lists):
        import hashlib

        import pandas as pd

        def one(value, hashes):
            if value is None or hashes is None or not len(hashes):
                return value
            gone = {int(x) for x in hashes}
            digest = lambda x: int.from_bytes(hashlib.blake2b(x, digest_size=8).digest(), "little", signed=True)
            return "\n".join(x for x in value.split("\n") if digest(b" ".join(x.encode().split()).lower()) not in gone)

        return pd.Series([one(a, b) for a, b in zip(texts, lists)], dtype=object)

    return clean(text, removed)
