"""Toxicity from two Kneser-Ney models of words, one of toxic and one of ordinary documents.

A model spells a word by its beginnings: three letters, then five, then seven, then the whole. Each step is a discounted count of the class;
what the discount frees goes to the shared backoff, the share of the distinct words of both classes that go on that way.
A word neither class has seen takes the ratio of its longest known beginning, and a word without one says
nothing. Both models rate every word of every document: the difference of the two log-likelihoods of a document is normalised by its
length. Words the toxic model makes likelier by LEAST or more are evidence besides, for a few of them drown in a long text. A
logistic curve turns the comparison and the evidence into a score.

All tables of the model are Spark tables that grow with the corpus; none of them reaches the driver.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyweave.llm.tokens import CHUNK_BYTES, chunks
from skyweave.llm.workspace import Workspace, numbered

CUTS = (3, 5, 7)
"""Letters of the beginnings a word backs off to."""
DISCOUNT = 0.75
LEAST = 2.5
"""Least log-likelihood ratio of a word that is evidence by itself."""
CALIBRATION_ROWS = 20_000
"""About the most labelled rows the curve over the features is fitted on; the counts of the models take all others."""
HELD_WORDS = 300_000
"""Words a task holds at a time; a block of documents ends with the chunk that reaches as many."""
PARTS = 256
"""Least number of parts the words are dealt to by a hash."""
PART_BYTES = 1 << 26
"""Bytes of text for each part, where that makes more parts: a task holds the ratios of a part at a time."""
SCALE = 1_000_000
"""Ratios are added up as whole millionths, so that no order of addition changes a score."""

FEATURES = ("comparison", "size", "excess", "strongest")
"""The sum of the ratios of all distinct words of a document by their number; the logarithm of that number, on which the spread of the first
depends; the sum of the ratios of its evidence by the root of the number, and the largest of them."""

_RUN = re.compile(r"[^\W\d_]+")
# Thai, Lao, Burmese, Khmer, kana and Han letters: scripts that do not part words.
_UNPARTED = re.compile("[฀-໿က-႟ក-៿぀-ヿ㐀-鿿豈-﫿]")


def words_of(text: str) -> set[str]:
    """The distinct words of a text: runs of letters in lower case, of scripts that do not part words all pairs of neighbours."""
    found = set(_RUN.findall(text.lower()))
    if not _UNPARTED.search(text):
        return found
    out = set()
    for word in found:
        if len(word) > 2 and _UNPARTED.search(word):
            out.update(word[i : i + 2] for i in range(len(word) - 1))
        else:
            out.add(word)
    return out


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of a partition with the ordinary and the toxic documents they are in."""
    held = (Counter(), Counter())

    def emptied():
        known = list(held[0].keys() | held[1].keys())
        for i in range(0, len(known), 50_000):
            part = known[i : i + 50_000]
            columns = [pa.array([held[y][w] for w in part], pa.int64()) for y in (0, 1)]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), *columns], names=["word", "n0", "n1"])
        for counts in held:
            counts.clear()

    for batch in batches:
        toxic = batch.column("toxic").to_pylist()
        for at, part in chunks(batch.column("text").fill_null(""), CHUNK_BYTES):
            for i, text in enumerate(part.to_pylist()):
                held[toxic[at + i]].update(words_of(text))
                if len(held[0]) + len(held[1]) > HELD_WORDS:
                    yield from emptied()
    yield from emptied()


def counted(labelled: DataFrame) -> DataFrame:
    """word, n0, n1: in how many ordinary and toxic documents of ``labelled`` (``text``, ``toxic`` 0 or 1) each word is."""
    rows = labelled.where(F.col("toxic").isin(0, 1)).select("text", F.col("toxic").cast("int").alias("toxic"))
    return (
        rows.mapInArrow(_counter, "word string, n0 long, n1 long")
        .groupBy("word")
        .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    )


def _children(words: DataFrame, nodes: dict[int, DataFrame], cut: int) -> DataFrame:
    """What follows the beginnings of ``cut`` letters: the next longer beginnings, and the words that end before those."""
    longer = [c for c in CUTS if c > cut]
    size = F.length("word")
    ends = (size > cut) & (size <= longer[0]) if longer else size > cut
    out = words.where(ends).select(
        F.col("word").alias("key"), F.lit(True).alias("whole"), "n0", "n1", F.lit(1).cast("long").alias("types")
    )
    if longer:
        out = out.unionByName(nodes[longer[0]].select("key", F.lit(False).alias("whole"), "n0", "n1", "types"))
    return out.withColumn("parent", F.substring("key", 1, cut))


def _share(y: int) -> Column:
    """Probability of a child under its parent, in class ``y``."""
    shared = F.col("types") / F.col("p_types")
    own = F.greatest(F.col(f"n{y}") - F.lit(DISCOUNT), F.lit(0.0)) + DISCOUNT * F.col(f"p_k{y}") * shared
    return F.when(F.col(f"p_n{y}") > 0, own / F.col(f"p_n{y}")).otherwise(shared)


def _freed(y: int) -> Column:
    """The weight of the backoff below a node, in class ``y``."""
    return F.when(F.col(f"n{y}") > 0, DISCOUNT * F.col(f"k{y}") / F.col(f"n{y}")).otherwise(F.lit(1.0))


@dataclass
class Model:
    words: DataFrame
    """word, ratio: log-likelihood of all known words under the toxic model less that under the ordinary one."""
    beginnings: DataFrame
    """key, ratio: the same for words that begin so and are known no further."""

    def rated(self, words: DataFrame, workspace: Workspace) -> DataFrame:
        """word, ratio of the distinct ``word`` rows; words without a known beginning are left out."""
        seen = workspace.keep(words.join(self.words, "word", "left"), "seen")
        out = seen.where(F.col("ratio").isNull()).select("word")
        for cut in CUTS:
            known = self.beginnings.where(F.length("key") == cut).select(F.col("key").alias(f"k{cut}"), F.col("ratio").alias(f"r{cut}"))
            begin = F.when(F.length("word") > cut, F.substring("word", 1, cut))
            out = out.withColumn(f"k{cut}", begin).join(known, f"k{cut}", "left")
        begun = out.select("word", F.coalesce(*[f"r{c}" for c in reversed(CUTS)]).alias("ratio"))
        return seen.union(begun).where(F.col("ratio").isNotNull())


def fitted(words: DataFrame, workspace: Workspace) -> Model:
    """Models from the table of ``counted``; without words of both classes nothing is known to them.

    Counts go up from words to beginnings, each level an aggregate of the one below; ratios come down by joins on the beginning.
    """
    nodes: dict[int, DataFrame] = {}
    for cut in (*reversed(CUTS), 0):
        below = _children(words, nodes, cut).groupBy(F.col("parent").alias("key"))
        table = below.agg(
            *[F.sum(c).alias(c) for c in ("n0", "n1", "types")], *[F.count_if(F.col(f"n{y}") > 0).alias(f"k{y}") for y in (0, 1)]
        )
        nodes[cut] = workspace.keep(table, f"nodes-{cut}")
    both = (F.col("n0") > 0) & (F.col("n1") > 0)
    # One row: the whole corpus.
    above = F.broadcast(nodes[0].where(both).withColumn("ratio", F.lit(0.0)))
    known, begun = [], []
    for cut in (0, *CUTS):
        parents = above.select(*[F.col(c).alias(f"p_{c}") for c in ("key", "ratio", "types", "n0", "n1", "k0", "k1")])
        children = _children(words, nodes, cut)
        stepped = children.join(parents, children.parent == F.col("p_key")).withColumn(
            "ratio", F.col("p_ratio") + F.log(_share(1) / _share(0))
        )
        kept = workspace.keep(stepped.select("key", "whole", "ratio"), f"ratios-{cut}")
        known.append(kept.where("whole").select(F.col("key").alias("word"), "ratio"))
        longer = [c for c in CUTS if c > cut]
        if longer:
            above = nodes[longer[0]].join(kept.where(~F.col("whole")).select("key", "ratio"), "key")
            begun.append(above.select("key", (F.col("ratio") + F.log(_freed(1) / _freed(0))).alias("ratio")))
    words, beginnings = known[0], begun[0]
    for part in known[1:]:
        words = words.union(part)
    for part in begun[1:]:
        beginnings = beginnings.union(part)
    model = Model(words, workspace.keep(beginnings, "beginnings"))
    workspace.drop(*[f"nodes-{cut}" for cut in nodes])
    return model


def packed(numbers: np.ndarray) -> bytes:
    """Whole numbers of 32 bits, all first bytes before all second ones, compressed."""
    return zlib.compress(np.ascontiguousarray(numbers, dtype="<i4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").ravel()


def parts_of(docs: DataFrame) -> int:
    """How many parts the words of ``docs`` are dealt to."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(PARTS, -(-size // PART_BYTES))


def indexed(docs: DataFrame, parts: int) -> DataFrame:
    """Rows of two kinds: the rows of ``docs`` without ``text`` as ``block``, ``at`` (the place in it) and ``n_words``; and for each
    ``part`` of the distinct words of a block these ``words``, parted by blanks, and packed in ``held`` for each word the number of rows it
    is in, then the places of these rows.

    Words are sent on once for each block and not for each document. Write the result before using it more than once.
    """
    rest = [c for c in docs.columns if c != "text"]
    fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in rest]
    fields += ["block long", "at int", "n_words long", "part int", "words string", "held binary"]
    most, chunk_bytes = HELD_WORDS, CHUNK_BYTES

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, rows, pairs, places = TaskContext.get().partitionId() << 33, 0, 0, defaultdict(list)
        kinds = None

        def filled(size, **columns):
            names = [*rest, "block", "at", "n_words", "part", "words", "held"]
            made = {"block": pa.array([block] * size, pa.int64()), **columns}
            return pa.RecordBatch.from_arrays([made[n] if n in made else pa.nulls(size, kinds[n]) for n in names], names=names)

        def emptied():
            dealt = defaultdict(list)
            for word in sorted(places):
                dealt[zlib.crc32(word.encode()) % parts].append(word)
            held = []
            for words in dealt.values():
                at = [places[w] for w in words]
                held.append(packed(np.fromiter(chain(map(len, at), chain.from_iterable(at)), dtype="<i4")))
            yield filled(
                len(dealt),
                part=pa.array(list(dealt), pa.int32()),
                words=pa.array([" ".join(words) for words in dealt.values()], pa.string()),
                held=pa.array(held, pa.binary()),
            )
            places.clear()

        for batch in batches:
            kinds = {c: batch.column(c).type for c in rest}
            kinds |= {"at": pa.int32(), "n_words": pa.int64(), "part": pa.int32(), "words": pa.string(), "held": pa.binary()}
            for start, part in chunks(batch.column("text").fill_null(""), chunk_bytes):
                sizes = []
                for i, text in enumerate(part.to_pylist()):
                    found = words_of(text)
                    sizes.append(len(found))
                    for word in found:
                        places[word].append(rows + i)
                given = {c: batch.column(c).slice(start, len(part)) for c in rest}
                at = pa.array(range(rows, rows + len(part)), pa.int32())
                yield filled(len(part), **given, at=at, n_words=pa.array(sizes, pa.int64()))
                rows, pairs = rows + len(part), pairs + sum(sizes)
                if pairs >= most:
                    yield from emptied()
                    block, rows, pairs = block + 1, 0, 0
        if places:
            yield from emptied()

    return docs.select("text", *[F.col(f"`{c}`") for c in rest]).mapInArrow(split, ", ".join(fields))


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows in the order of their parts, known words first: block, part and the packed codes of the words asked for, 0 if unknown."""
    now, codes = None, {}
    for batch in batches:
        rows, found = [batch.column(c).to_pylist() for c in ("part", "block", "words", "code")], []
        for part, block, words, code in zip(*rows):
            if part != now:
                now, codes = part, {}
            if block is None:
                codes[words] = code
            else:
                found.append((block, part, packed(np.array([codes.get(w, 0) for w in words.split(" ")]))))
        columns = zip(*found) if found else ([], [], [])
        kinds = {"block": pa.int64(), "part": pa.int32(), "codes": pa.binary()}
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values())], names=list(kinds))


def answered(asked: DataFrame, rated: DataFrame, parts: int) -> DataFrame:
    """block, part, codes: for the ``words`` of each row of ``asked`` (``block``, ``part``, ``words``) twice the ratio in ``rated`` in whole
    millionths, and 1 more for evidence.

    Words travel as one text for each block and part; ratios come back without them.
    """
    code = 2 * F.round(F.col("ratio") * SCALE) + (F.col("ratio") >= LEAST).cast("int")
    known = rated.select(
        F.pmod(F.crc32("word"), F.lit(parts)).cast("int").alias("part"),
        F.lit(None).cast("long").alias("block"),
        F.col("word").alias("words"),
        code.cast("int").alias("code"),
    )
    both = known.unionByName(asked.select("part", "block", "words", F.lit(None).cast("int").alias("code")))
    return both.repartition("part").sortWithinPartitions("part", "block").mapInArrow(_answers, "block long, part int, codes binary")


def summed(held: pa.Table, answers: pa.Table) -> pa.Table:
    """Sums over the words of each row of a block: all ratios, those of evidence, and the largest of these."""
    codes = dict(zip(answers.column("part").to_pylist(), answers.column("codes").to_pylist()))
    places, met = [], []
    for part, data in zip(held.column("part").to_pylist(), held.column("held").to_pylist()):
        code, data = unpacked(codes[part]), unpacked(data)
        places.append(data[len(code) :])
        met.append(np.repeat(code, data[: len(code)]))
    at, row = np.unique(np.concatenate(places), return_inverse=True)
    met = np.concatenate(met).astype(np.int64)
    ratio = met >> 1
    strong = np.where(met & 1, ratio, 0)
    sums, top = np.zeros((2, len(at)), dtype=np.int64), np.zeros(len(at), dtype=np.int64)
    np.add.at(sums[0], row, ratio)
    np.add.at(sums[1], row, strong)
    np.maximum.at(top, row, strong)
    block = [held.column("block")[0].as_py()] * len(at)
    return pa.table(
        {"block": pa.array(block, pa.int64()), "at": pa.array(at, pa.int32()), "all": sums[0], "strong": sums[1], "top": top}
    )


def described(docs: DataFrame, model: Model, workspace: Workspace) -> DataFrame:
    """Every row of ``docs`` (``doc_id``, ``text``): row_id, doc_id, FEATURES; zeros for texts without known words.

    Texts are not shuffled: a task sends on the distinct words of a block of documents, packed by parts; the ratios come back to the block and
    meet the places of the words there.
    """
    parts = parts_of(docs)
    found = workspace.keep(indexed(docs.select("doc_id", "text"), parts), "indexed")
    blocks = found.where(F.col("words").isNotNull())
    words = blocks.select(F.explode(F.split("words", " ")).alias("word"))
    rated = workspace.keep(model.rated(words.distinct(), workspace), "rated")
    workspace.drop("seen")
    answers = workspace.keep(answered(blocks, rated, parts), "answers")
    workspace.drop("rated")
    sums = (
        blocks.select("block", "part", "held")
        .groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(lambda a, b: summed(a, b), "block long, at int, all long, strong long, top long")
    )
    every = found.where(F.col("words").isNull()).select("block", "at", "doc_id", "n_words").join(sums, ["block", "at"], "left")
    zero = F.lit(0.0)
    out = workspace.keep(
        numbered(
            every.select(
                "doc_id",
                F.coalesce(F.col("all") / SCALE / F.col("n_words"), zero).alias("comparison"),
                F.log1p("n_words").alias("size"),
                F.coalesce(F.col("strong") / SCALE / F.sqrt("n_words"), zero).alias("excess"),
                F.coalesce(F.col("top") / SCALE, zero).alias("strongest"),
            )
        ).select("row_id", "doc_id", *FEATURES),
        "described",
    )
    workspace.drop("indexed", "answers")
    return out


@dataclass
class Curve:
    weights: tuple[float, ...]
    intercept: float

    def score(self) -> Column:
        total = F.lit(self.intercept)
        for name, weight in zip(FEATURES, self.weights):
            total = total + F.lit(weight) * F.col(name)
        return 1 / (1 + F.exp(-total))


DEFAULT_CURVE = Curve((1.0, 0.0, 1.0, 0.5), -3.0)
"""For corpora with too few labelled rows to fit a curve."""


def curve(rows: DataFrame) -> Curve:
    """The logistic curve over rows of doc_id, FEATURES and ``toxic``, fitted on about CALIBRATION_ROWS, drawn by a hash of doc_id."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    kinds = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if min(kinds.get(0, 0), kinds.get(1, 0)) < 5:
        return DEFAULT_CURVE
    share = min(1.0, CALIBRATION_ROWS / sum(kinds.values()))
    drawn = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * share))
    packed = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(drawn)
    found = LogisticRegression(labelCol="toxic", regParam=0.0005, maxIter=100).fit(
        packed.select("features", F.col("toxic").cast("double").alias("toxic"))
    )
    return Curve(tuple(float(x) for x in found.coefficients), float(found.intercept))


def toxicity(docs: DataFrame, labels: DataFrame, fold, workspace: Workspace) -> DataFrame:
    """Every row of ``docs`` (``doc_id``, ``text``): doc_id, held_out, score, predicted and the features.

    ``fold`` is a column of 0 to 4 made of doc_id: labels (``doc_id``, ``toxic``) are learnt from outside fold 0 only, words
    from folds 2 to 4 and the curve from fold 1, so that it sees words as strange as new ones are. Texts pass
    through one shuffle, for the join with the labels of three folds; all rows are described by the words of their blocks. Null and empty texts
    score like texts without any sign; very long ones are read whole; null ids are in no fold; null labels and other values than 0
    and 1 are left out. Repeated rows score alike; an empty table gives an empty result; other columns are not looked at. Without
    labels of both kinds no word has a ratio and DEFAULT_CURVE holds.
    """
    known = labels.where(F.col("toxic").isin(0, 1)).select("doc_id", "toxic")
    # Labels grow with the documents, so they are never broadcast: the plan is the same at every size.
    learnt = docs.select("doc_id", "text").where(fold >= 2).join(known.where(fold >= 2).hint("merge"), "doc_id")
    words = workspace.keep(counted(learnt.select("text", "toxic")), "words")
    model = fitted(words, workspace)
    workspace.drop("words")
    rows = described(docs, model, workspace)
    line = curve(rows.where(fold == 1).join(known, "doc_id").select("doc_id", "toxic", *FEATURES))
    return (
        rows.withColumn("held_out", F.coalesce(fold == 0, F.lit(False)))
        .withColumn("score", line.score())
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
        .select("doc_id", "held_out", "score", "predicted", *FEATURES)
    )
