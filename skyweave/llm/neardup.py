"""Near-duplicate documents by SetSketch registers.

A document's sketch holds, for each of ``registers`` hash functions, the smallest exponentially distributed value of its
shingles on a logarithmic scale, cut off at both ends. Sketches of parts merge by the register-wise maximum; equal
registers are about as likely as shingles are shared. Documents that agree in a band of registers are candidates, the
likelihood of all register pairs together estimates the similarity, and full sets confirm each link.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyweave.llm.graph import components
from skyweave.llm.tokens import chunks, mix, odd_numbers, shingles, words
from skyweave.llm.workspace import Workspace


@dataclass(frozen=True)
class Similarity:
    """When two documents are linked: ``100 * common >= percent * union`` of their shingle sets."""

    shingle: int = 5
    percent: int = 80
    registers: int = 128
    """Four in a band: 32 bands miss a pair at 80 % with probability (1 - 0.8 ** 4) ** 32, under one in ten million."""
    base: float = 1.001
    rate: float = 20.0
    limit: int = 65_534
    deviations: float = 5.0
    """Candidates estimated this many standard deviations below the limit are dropped without a look at the sets."""

    @property
    def least_estimate(self) -> float:
        j = self.percent / 100
        return j - self.deviations * (j * (1 - j) / self.registers) ** 0.5


ROWS = 4
SLOTS = (2, 16, 64, 256)
"""Most members of a bucket that all others are compared with, by round; the last entry holds for all later rounds."""

BLOCK = 512
"""Members of a bucket that one call compares with the leaders."""


def registers(value: np.ndarray, row: np.ndarray, rows: int, how: Similarity) -> np.ndarray:
    """Sketches of the rows' sets (``shingles``): rows x registers, uint16; rows without shingles are all zero."""
    out = np.zeros((rows, how.registers), dtype=np.uint16)
    if not len(value):
        return out
    first = np.concatenate(([0], np.flatnonzero(np.diff(row)) + 1))
    least = np.empty((how.registers, len(first)), dtype=np.uint64)
    shifts = odd_numbers(11, how.registers)
    factors = odd_numbers(12, how.registers)
    scratch = np.empty_like(value)
    for i in range(how.registers):
        np.bitwise_xor(value, shifts[i], out=scratch)
        np.multiply(scratch, factors[i], out=scratch)
        least[i] = np.minimum.reduceat(scratch, first)
    smallest = -np.log1p(-(least.T.astype(np.float64) + 0.5) / 2.0**64) / how.rate
    level = np.floor(1 - np.log(smallest) / np.log(how.base))
    out[row[first]] = np.clip(level, 0, how.limit + 1).astype(np.uint16)
    return out


def merged(*sketches: np.ndarray) -> np.ndarray:
    """The sketch of the union."""
    return np.maximum.reduce(sketches)


def estimated(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, base: float) -> np.ndarray:
    """The similarity under which the observed orders of all register pairs are likeliest, for pairs of sketches of sets of
    known sizes; searched on the concave log-likelihood by golden section."""
    above, below = (a > b).sum(axis=1), (a < b).sum(axis=1)
    same = a.shape[1] - above - below
    u = n_a / (n_a + n_b)
    v = 1 - u
    scale = (base - 1) / base

    def chance(x):
        return -np.log1p(-np.clip(x, 0, 1) * scale) / np.log(base)

    def likelihood(j):
        p, q = chance(u - v * j), chance(v - u * j)
        tiny = 1e-12
        return (
            above * np.log(np.maximum(p, tiny))
            + below * np.log(np.maximum(q, tiny))
            + same * np.log(np.maximum(1 - p - q, tiny))
        )

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    ratio = (5**0.5 - 1) / 2
    for _ in range(24):
        left, right = high - ratio * (high - low), low + ratio * (high - low)
        up = likelihood(left) < likelihood(right)
        low, high = np.where(up, left, low), np.where(up, high, right)
    return (low + high) / 2


_SKETCH = (
    "row_id long, doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, text string"
)


def _sketcher(how: Similarity, extra: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 33
        width = how.registers // ROWS
        for batch in batches:
            texts = batch.column("text").fill_null("")
            for at, part in chunks(texts):
                value, row = shingles(words(part, lower=True), how.shingle)
                sizes = np.bincount(row, minlength=len(part))
                folded = np.zeros((2, len(part)), dtype=np.uint64)
                if len(value):
                    first = np.concatenate(([0], np.flatnonzero(np.diff(row)) + 1))
                    folded[0, row[first]] = np.add.reduceat(value, first)
                    folded[1, row[first]] = np.add.reduceat(mix(value ^ np.uint64(0x5851F42D4C957F2D)), first)
                bands = registers(value, row, len(part), how).view(np.int64).reshape(-1)
                offsets = np.arange(0, width * len(part) + 1, width, dtype=np.int32)
                others = [batch.column(2 + i).slice(at, len(part)) for i in range(extra)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(number + np.arange(len(part)), pa.int64()),
                        batch.column("doc_id").slice(at, len(part)),
                        pa.array(sizes, pa.int64()),
                        pa.array(folded[0].view(np.int64)),
                        pa.array(folded[1].view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(bands)),
                        part.cast(pa.string()),
                        *others,
                    ],
                    names=["row_id", "doc_id", "n_shingles", "set_a", "set_b", "bands", "text", *batch.schema.names[2:]],
                )
                number += len(part)

    return sketch


def _estimator(how: Similarity):
    def unpacked(column) -> np.ndarray:
        flat = column.flatten().to_numpy(zero_copy_only=False)
        return np.ascontiguousarray(flat, dtype=np.int64).view(np.uint16).reshape(len(column), how.registers)

    def estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes = [batch.column(n).to_numpy().astype(np.float64) for n in ("n_x", "n_y")]
            j = estimated(unpacked(batch.column("bands_x")), unpacked(batch.column("bands_y")), *sizes, how.base)
            near = np.flatnonzero(j >= how.least_estimate)
            yield pa.RecordBatch.from_arrays(
                [batch.column("x").take(near), batch.column("y").take(near), pa.array(j[near])], names=["x", "y", "near"]
            )

    return estimate


def _verifier(how: Similarity):
    def sets(keys: np.ndarray, column: pa.Array) -> dict[int, np.ndarray]:
        """The set of each class in a batch, made once however many pairs it is in."""
        known, first = np.unique(keys, return_index=True)
        out = []
        for _, part in chunks(column.take(pa.array(first))):
            value, row = shingles(words(part, lower=True), how.shingle)
            bounds = np.searchsorted(row, np.arange(len(part) + 1))
            out += [value[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        return dict(zip(known.tolist(), out))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (batch.column(n).to_numpy() for n in "xy")
            left, right = sets(x, batch.column("text_x")), sets(y, batch.column("text_y"))
            keep = [i for i, (a, b) in enumerate(zip(x.tolist(), y.tolist())) if _linked(left[a], right[b], how)]
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]), pa.array(y[keep])], names=["x", "y"])

    return verify


def _setter(how: Similarity):
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, part in chunks(batch.column("text")):
                value, row = shingles(words(part, lower=True), how.shingle)
                offsets = np.searchsorted(row, np.arange(len(part) + 1)).astype(np.int32)
                sets = pa.ListArray.from_arrays(pa.array(offsets), pa.array(value.view(np.int64)))
                kept = [batch.column(n).slice(at, len(part)) for n in ("cls", "bands")]
                yield pa.RecordBatch.from_arrays([*kept, sets], names=["cls", "bands", "shingles"])

    return spread


def _matchable(members: DataFrame, opened: DataFrame) -> DataFrame:
    """``cls`` and the number of its shingles that occur in no other class of ``members``, where there are any."""
    return (
        opened.join(members.select("cls").distinct(), "cls")
        .select("cls", F.explode("shingles").alias("shingle"))
        .groupBy("shingle").agg(F.count("*").alias("times"), F.min("cls").alias("cls"))
        .where("times = 1").groupBy("cls").agg(F.count("*").alias("alone"))
    )


def _comparer(how: Similarity):
    """Links between the members of a block and the leaders of its bucket: both carry sketch and set, so only links
    leave the task."""
    schema = pa.schema([("x", pa.int64()), ("y", pa.int64())])

    def side(table: pa.Table):
        n, m, comp, cls = (table.column(c).to_numpy() for c in ("n", "m", "comp", "cls"))
        bands = table.column("bands").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        sketch = np.ascontiguousarray(bands, dtype=np.int64).view(np.uint16).reshape(len(n), how.registers)
        lists = table.column("shingles").combine_chunks()
        offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
        return n.astype(np.float64), m, comp, cls, sketch, [flat[a:b] for a, b in zip(offsets[:-1], offsets[1:])]

    def compare(members: pa.Table, heads: pa.Table) -> pa.Table:
        if not members.num_rows or not heads.num_rows:
            return schema.empty_table()
        n, m, comp, cls, sketch, sets = side(members)
        found = []
        for n_h, m_h, comp_h, cls_h, sketch_h, set_h in zip(*side(heads)):
            most = np.minimum(m, m_h)
            at = np.flatnonzero((comp != comp_h) & (100 * most >= how.percent * (n + n_h - most)))
            if not len(at):
                continue
            one = np.broadcast_to(sketch_h, (len(at), how.registers))
            j = estimated(sketch[at], one, n[at], np.full(len(at), n_h), how.base)
            for i in at[j >= how.least_estimate]:
                if _linked(sets[i], set_h, how):
                    found.append((min(cls[i], cls_h), max(cls[i], cls_h)))
        x, y = zip(*found) if found else ([], [])
        return pa.table([pa.array(x, pa.int64()), pa.array(y, pa.int64())], schema=schema)

    return compare


def _linked(a: np.ndarray, b: np.ndarray, how: Similarity) -> bool:
    joint = np.concatenate((a, b))
    joint.sort(kind="stable")
    common = int((joint[1:] == joint[:-1]).sum())
    return 100 * common >= how.percent * (len(joint) - common)


def _possible(common, n_x, n_y, how: Similarity):
    """Whether two sets that share at most ``common`` shingles may be linked."""
    return 100 * common >= how.percent * (n_x + n_y - common)


def _beside(pairs: DataFrame, cards: DataFrame, names: list[str]) -> DataFrame:
    """``pairs`` of x and y with the named columns of both classes' cards."""
    for side in "xy":
        part = cards.select(F.col("cls").alias(side), *[F.col(n).alias(f"{n}_{side}") for n in names])
        pairs = pairs.join(part, side)
    return pairs


def _first_links(members: DataFrame, leaders: DataFrame, cards: DataFrame, workspace: Workspace, how: Similarity):
    """Links between all members and their buckets' leaders: distinct pairs, estimated from sketches, then
    confirmed on the texts of those that are left."""
    heads = leaders.groupBy("bucket").agg(F.collect_list(F.struct("cls", "n")).alias("heads"))
    met = members.join(workspace.keep(heads, "heads"), "bucket").select("cls", "n", F.explode("heads").alias("head"))
    fits = _possible(F.least("n", "head.n"), F.col("n"), F.col("head.n"), how)
    pairs = (
        met.where((F.col("cls") != F.col("head.cls")) & fits)
        .select(F.least("cls", "head.cls").alias("x"), F.greatest("cls", "head.cls").alias("y"))
        .distinct()
    )
    near = (
        _beside(workspace.keep(pairs, "pairs"), cards, ["n", "bands"])
        .select("x", "y", "n_x", "n_y", "bands_x", "bands_y")
        .mapInArrow(_estimator(how), "x long, y long, near double")
    )
    near = workspace.keep(near, "near").select("x", "y")
    texts = _beside(near, cards, ["text"]).select("x", "y", "text_x", "text_y")
    return texts.mapInArrow(_verifier(how), "x long, y long")


def _block_links(members: DataFrame, leaders: DataFrame, open_: DataFrame, opened: DataFrame, how: Similarity):
    """Links between members and leaders of the open buckets, a block of a bucket at a time."""
    columns = ["bucket", "block", "cls", "n", "m", "comp", "bands", "shingles"]
    place = F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int").alias("block")
    body = members.join(open_.select("bucket", "blocks"), "bucket").select("bucket", place, "cls", "n", "m", "comp")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    heads = leaders.select("bucket", every, "cls", "n", "m", "comp")
    compare = _comparer(how)
    return (
        body.join(opened, "cls").select(*columns).groupBy("bucket", "block")
        .cogroup(heads.join(opened, "cls").select(*[F.col(c).alias(c) for c in columns]).groupBy("bucket", "block"))
        .applyInArrow(lambda a, b: compare(a, b), "x long, y long")
    )


def _sketched(docs: DataFrame, workspace: Workspace, how: Similarity, kept_cols: list[str] = ()) -> DataFrame:
    extra = [F.col(f"`{c}`").alias(f"in_{c}") for c in kept_cols]
    types = "".join(f", `in_{c}` {docs.schema[c].dataType.simpleString()}" for c in kept_cols)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *extra)
    return workspace.keep(source.mapInArrow(_sketcher(how, len(extra)), _SKETCH + types), "base")


def _placed(base: DataFrame, workspace: Workspace, how: Similarity) -> DataFrame:
    """Every class of equal sets with its component: the component's smallest doc_id and the row that stays of it.

    Within a bucket (classes that agree in a band) a few leaders are compared with all members, so a bucket makes
    rows in proportion to its members and never all pairs. Links found join classes to components. A bucket whose members still
    belong to several components is taken up again without its former leaders and with new ones from outside its largest
    component, until every remaining bucket lies within one component: at that point each pair of a bucket has been compared,
    is joined already or can't be linked. The last holds for texts too many of whose shingles occur in no other text that
    is still open: what they can share bounds their similarity, which spares loose groups of copies nearly all
    comparisons. Nothing is capped.
    """
    classes = workspace.keep(
        base.where("n_shingles > 0")
        .groupBy("set_a", "set_b", "n_shingles")
        .agg(
            F.min("row_id").alias("cls"),
            F.min("doc_id").alias("least_id"),
            F.min_by("row_id", F.struct(F.col("doc_id").isNull(), "doc_id", "row_id")).alias("first_row"),
        ),
        "classes",
    )
    banded = (
        base.select("row_id", "n_shingles", "bands")
        .join(classes.select(F.col("cls").alias("row_id")), "row_id")
        .select(F.col("row_id").alias("cls"), F.col("n_shingles").alias("n"), F.posexplode("bands").alias("band", "key"))
        .select(F.xxhash64("band", "key").alias("bucket"), "cls", "n", F.col("n").alias("m"))
    )
    shared = banded.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1").select("bucket")
    shared = workspace.keep(shared, "shared")
    members = workspace.keep(banded.join(shared, "bucket"), "members-0")
    cards = workspace.keep(
        base.select(F.col("row_id").alias("cls"), F.col("n_shingles").alias("n"), "bands", "text").join(
            members.select("cls").distinct(), "cls"
        ),
        "cards",
    )
    workspace.drop("shared")
    roots, links, opened = None, None, None
    turn = 0
    while True:
        labelled = members.withColumn("comp", F.col("cls"))
        if roots is not None:
            labelled = members.join(roots.select(F.col("node").alias("cls"), "root"), "cls", "left").select(
                "bucket", "cls", "n", "m", F.coalesce("root", "cls").alias("comp")
            )
        labelled = workspace.keep(labelled, f"labelled-{turn}") if turn else labelled
        sizes = labelled.groupBy("bucket", "comp").agg(F.count("*").alias("size"))
        open_ = sizes.groupBy("bucket").agg(
            F.count("*").alias("groups"),
            F.max_by("comp", F.struct("size", -F.col("comp"))).alias("largest"),
            F.ceil(F.sum("size") / BLOCK).cast("int").alias("blocks"),
        )
        open_ = workspace.keep(open_.where("groups > 1").drop("groups"), f"open-{turn}")
        if open_.isEmpty():
            break
        slots = SLOTS[min(turn, len(SLOTS) - 1)]
        leaders = workspace.keep(
            labelled.join(open_, "bucket")
            .where("comp <> largest")
            .groupBy("bucket", F.pmod(F.xxhash64("cls"), F.lit(slots)).alias("slot"))
            .agg(F.min("cls").alias("cls"), *[F.min_by(c, "cls").alias(c) for c in ("n", "m", "comp", "blocks")]),
            f"leaders-{turn}",
        )
        if turn == 0:
            found = _first_links(labelled, leaders, cards, workspace, how)
        else:
            found = _block_links(labelled, leaders, open_, opened, how)
        found = workspace.keep(found, f"links-{turn}").select(F.col("x").alias("a"), F.col("y").alias("b"))
        if not found.isEmpty():
            links = found if links is None else links.unionByName(found)
            roots = components(links, workspace, f"cc-{turn}")
        left = workspace.keep(
            members.join(open_.select("bucket"), "bucket", "left_semi").join(
                leaders.select("bucket", "cls"), ["bucket", "cls"], "left_anti"
            ),
            f"left-{turn}",
        )
        if turn == 0:
            kept = cards.join(left.select("cls").distinct(), "cls").select("cls", "bands", "text")
            opened = workspace.keep(
                kept.mapInArrow(_setter(how), "cls long, bands array<long>, shingles array<long>"), "opened"
            )
            workspace.drop("cards")
        alone = workspace.keep(_matchable(left, opened), f"alone-{turn}")
        smallest = workspace.keep(left.groupBy("bucket").agg(F.min("n").alias("least")), f"smallest-{turn}")
        members_next = workspace.keep(
            left.join(alone, "cls", "left")
            .withColumn("m", F.col("n") - F.coalesce("alone", F.lit(0)))
            .join(smallest, "bucket")
            .where(_possible(F.col("m"), F.col("n"), F.greatest("least", "m"), how))
            .select("bucket", "cls", "n", "m"),
            f"members-{turn + 1}",
        )
        workspace.drop(*[f"{x}-{turn}" for x in ("left", "alone", "smallest", "members", "labelled", "open", "leaders")])
        members = members_next
        turn += 1
    workspace.drop("cards", "opened", f"members-{turn}", f"labelled-{turn}")
    placed = classes.withColumn("root", F.col("cls"))
    if roots is not None:
        found = roots.select(F.col("node").alias("cls"), F.col("root").alias("top"))
        placed = classes.join(found, "cls", "left").withColumn("root", F.coalesce("top", "cls")).drop("top")
    first = F.struct(F.col("least_id").isNull(), "least_id", "cls")
    heads = placed.groupBy("root").agg(
        F.min("least_id").alias("component_id"), F.min_by("first_row", first).alias("keeper")
    )
    return workspace.keep(
        placed.join(workspace.keep(heads, "heads-of-all"), "root").select(
            "set_a", "set_b", "n_shingles", "cls", "component_id", "keeper"
        ),
        "placed",
    )


def near_duplicates(docs: DataFrame, workspace: Workspace, how: Similarity = Similarity()) -> DataFrame:
    """A row per row of ``docs`` (``doc_id``, ``text``): row_id, doc_id, n_shingles, set_id, component_id, kept.

    ``component_id`` is the smallest doc_id reachable over links, ``kept`` marks rows with that very id. Rows with one set are
    one class (``set_id``) whatever their number; classes are compared, copies never. Null texts and texts without words have
    an empty set and are linked with nothing. Null ids count as missing when the smallest is taken. Repeated rows are rows of
    one class. Empty tables give empty results; other columns are not looked at.
    """
    base = _sketched(docs, workspace, how)
    placed = _placed(base, workspace, how)
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return (
        base.select("row_id", "doc_id", "n_shingles", "set_a", "set_b")
        .join(placed, ["set_a", "set_b", "n_shingles"], "left")
        .withColumn("component_id", component)
        .select(
            "row_id",
            "doc_id",
            "n_shingles",
            F.coalesce("cls", "row_id").alias("set_id"),
            "component_id",
            F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
        )
    )


def one_of_each(docs: DataFrame, workspace: Workspace, how: Similarity = Similarity()) -> DataFrame:
    """``docs`` with one row of each group of linked documents: that with the smallest doc_id, null ids last, and one of
    several rows with that id. Rows without words are in no group and stay."""
    base = _sketched(docs, workspace, how, docs.columns)
    placed = _placed(base, workspace, how).select("set_a", "set_b", "n_shingles", "keeper")
    # The rows to leave out are fewer than those that stay, and only their numbers are joined to the texts.
    others = (
        base.select("row_id", "set_a", "set_b", "n_shingles")
        .join(placed, ["set_a", "set_b", "n_shingles"])
        .where("row_id <> keeper")
        .select("row_id")
    )
    kept = base.join(workspace.keep(others, "others"), "row_id", "left_anti")
    return kept.select(*[F.col(f"`in_{c}`").alias(c) for c in docs.columns])
