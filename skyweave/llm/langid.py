"""Language by compression: a text is in the language whose dictionary makes it smallest."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SAMPLE_TEXTS = 120
"""Most texts a dictionary is made of: the bound of the fit."""
EXCERPT = 150
"""Characters of each of them."""
DICTIONARY_BYTES = 16_384
PIECE = 1_500
"""Characters compressed at a time, so that the dictionary counts for a long text as much as for a short one."""
LEVEL = 5
CLOSE_BYTES = 8
"""Where the two smallest sizes are no further apart than this, phrases decide: the format counts whole bytes of whole blocks."""
LEAST_MARGIN = 0.01
"""Predictions whose best size is not smaller than the second by this share are not accepted."""
UNKNOWN = "und"

_LETTERS = re.compile(r"[^\W\d_]+")


def plain(text: str) -> str:
    """The words of a text in lower case, a word that follows itself once."""
    words = _LETTERS.findall(text.lower())
    return " ".join([w for w, before in zip(words, [None, *words]) if w != before])


def dictionaries(labelled: DataFrame) -> dict[str, bytes]:
    """Raw dictionaries from ``text`` and ``lang``: excerpts of up to SAMPLE_TEXTS distinct texts of each language.

    Texts are taken in the order of a hash, each once however often it occurs; excerpts start at a place that the hash
    names too. A hash threshold from each language's count of texts thins them out to a few times SAMPLE_TEXTS before any of them is
    shuffled. Languages grow the result, rows don't.
    """
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select(
        "text", F.col("lang").cast("string").alias("lang"), F.xxhash64("text").alias("h")
    )
    order = Window.partitionBy("lang").orderBy("h")
    # The smallest hashes are taken, so those below a limit that leaves about four times as many hold them all.
    share = 4 * SAMPLE_TEXTS / F.approx_count_distinct("h")
    limits = rows.groupBy("lang").agg(
        F.when(share < 1, (share * 2.0**64 - 2.0**63).cast("long")).otherwise(F.lit(2**63 - 1)).alias("limit")
    )
    drawn = rows.select("lang", "h").join(F.broadcast(limits), "lang").where(F.col("h") <= F.col("limit"))
    chosen = (
        drawn.select("lang", "h").distinct().withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= SAMPLE_TEXTS).select("lang", "h")
    )
    picked = [(r.lang, r.h) for r in chosen.collect()]
    if not picked:
        return {}
    spark = labelled.sparkSession
    wanted = F.broadcast(spark.createDataFrame(picked, "lang string, h long"))
    room = F.greatest(F.length("text") - EXCERPT, F.lit(0)) + 1
    start = (F.pmod("h", room) + 1).cast("int")
    excerpts = (
        rows.join(wanted, ["lang", "h"])
        .select("lang", "h", F.substr("text", start, F.lit(EXCERPT)).alias("part"))
        .groupBy("lang", "h")
        .agg(F.min("part").alias("part"))
        .collect()
    )
    out: dict[str, list[str]] = {}
    for row in sorted(excerpts, key=lambda r: (r.lang, r.h)):
        out.setdefault(row.lang, []).append(plain(row.part))
    return {lang: (" " + " ".join(parts) + " ").encode()[-DICTIONARY_BYTES:] for lang, parts in out.items()}


@dataclass
class Sizes:
    """Compressors by language."""

    raw: dict[str, bytes]
    langs: list[str] = field(init=False)

    def __post_init__(self):
        self.langs = sorted(self.raw)
        self._tools = []
        for lang in self.langs:
            if len(self.raw[lang]) < 8:
                self._tools.append(zstandard.ZstdCompressor(level=LEVEL, write_content_size=False))
                continue
            known = zstandard.ZstdCompressionDict(self.raw[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            known.precompute_compress(level=LEVEL)
            self._tools.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_content_size=False))

    def of(self, text: str) -> np.ndarray:
        """Bytes of a plain text under each dictionary; where the two smallest are within CLOSE_BYTES, the phrases that a greedy
        parse against each dictionary needs are added."""
        body = f" {text} "
        pieces = [body[i : i + PIECE].encode() for i in range(0, len(body), PIECE)]
        sizes = np.array([float(sum(len(t.compress(p)) for p in pieces)) for t in self._tools])
        if len(sizes) > 1 and np.diff(np.partition(sizes, 1)[:2])[0] <= CLOSE_BYTES:
            sizes += [_phrases(body.encode(), self.raw[lang]) for lang in self.langs]
        return sizes

    def predict(self, text: str | None) -> tuple[str, float, float, bool]:
        """Language, score, margin, accepted."""
        words = plain(text or "")
        if not words or not self.langs:
            return UNKNOWN, 0.0, 0.0, False
        sizes = self.of(words)
        best = int(np.argmin(sizes))
        others = np.delete(sizes, best)
        margin = float((others.min() - sizes[best]) / others.min()) if len(others) else 1.0
        score = 1 / (1 + float(np.exp(-np.minimum(others - sizes[best], 700)).sum()))
        return self.langs[best], score, margin, margin >= LEAST_MARGIN


def _phrases(body: bytes, raw: bytes) -> float:
    at, count = 0, 0
    while at < len(body):
        low, high = 0, min(len(body) - at, 64)
        while low < high:
            middle = (low + high + 1) // 2
            if body[at : at + middle] in raw:
                low = middle
            else:
                high = middle - 1
        at += max(low, 1)
        count += 1
    return float(count)


def predicted(docs: DataFrame, raw: dict[str, bytes]) -> DataFrame:
    """``docs`` (``text`` and others) with lang_pred, score, margin and accepted in place of the text.

    ``und`` stands for null texts and texts without a letter, with score 0, and for all texts where no language has been learnt.
    Ties go to the first language by name. Whole texts are compressed, piece by piece.
    """
    rest = [c for c in docs.columns if c != "text"]
    shared = docs.sparkSession.sparkContext.broadcast(raw)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(shared.value)
        for batch in batches:
            found = [sizes.predict(x.as_py()) for x in batch.column("text")]
            columns = list(zip(*found)) if found else [[], [], [], []]
            kinds = [pa.string(), pa.float64(), pa.float64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in rest], *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                names=[*rest, "lang_pred", "score", "margin", "accepted"],
            )

    fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in rest]
    fields += ["lang_pred string", "score double", "margin double", "accepted boolean"]
    return docs.select("text", *[F.col(f"`{c}`") for c in rest]).mapInArrow(predict, ", ".join(fields))


def language(docs: DataFrame, learn) -> DataFrame:
    """Every row of ``docs`` (``doc_id``, ``text``, ``lang``): doc_id, lang_pred, score, margin, accepted.

    Dictionaries are made of the rows for which the column ``learn`` holds and whose ``lang`` is not null; a prediction
    sees the text alone. Repeated rows are predicted alike, an empty table gives an empty result, other
    columns are not looked at.
    """
    raw = dictionaries(docs.where(learn).select("text", "lang"))
    return predicted(docs.select("doc_id", "text"), raw)
