"""Exact duplicates: compressed radix tries over full byte strings, one per partition of lengths and content hashes.

A trie holds each different text once and decides equality on all of its bytes; hashes only deal texts out to partitions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyweave.llm.workspace import Workspace, numbered

TRIE_BYTES = 64 << 20
"""Bytes of text a trie holds before a map task passes it on, or a partition spills subtrees."""

PARTITION_BYTES = 128 << 20
"""Bytes of different texts dealt to one partition."""

_END = -1
_NO_ID = 2**64
"""Stands behind every id."""

_NODE_BYTES = 600
"""What a terminal node costs beside its text."""


class _Leaf:
    """A terminal node: the text, the number of rows that have it, and the identifier that comes first among them."""

    __slots__ = ("key", "number", "rows", "first")

    def __init__(self, key: bytes, number: int):
        self.key, self.number = key, number
        self.rows, self.first = 0, None

    def add(self, rows: int, order: tuple) -> None:
        self.rows += rows
        if self.first is None or order < self.first:
            self.first = order


class _Branch:
    """An inner node: all texts below agree up to ``at`` and differ in the byte there; _END stands behind a text's last byte."""

    __slots__ = ("at", "below")

    def __init__(self, at: int):
        self.at, self.below = at, {}


class _Spilled:
    """Marks a subtree whose texts are left to a later pass."""

    __slots__ = ("number",)

    def __init__(self, number: int):
        self.number = number


def _byte(key: bytes, at: int) -> int:
    return key[at] if at < len(key) else _END


def first_difference(a: bytes, b: bytes) -> int:
    """The first place at which two different byte strings differ; the end of the shorter one counts as a place."""
    low, high = 0, min(len(a), len(b))
    step = 64
    while low + step < high and a[low : low + step] == b[low : low + step]:
        low += step
        step *= 2
    high = min(high, low + step)
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Trie:
    """A Patricia trie of byte strings.

    A search follows only the bytes at which stored texts differ and compares the whole text once, at the end. ``insert``
    gives the text's terminal node, or the number of the spilled subtree it belongs to. Every branch keeps at least one text
    that is not spilled, so each pass settles some texts and a search always has one to compare with.
    """

    def __init__(self):
        self.root = None
        self.bytes = 0
        self.count = 0
        self.spills = 0

    def _any(self, node) -> _Leaf:
        while not isinstance(node, _Leaf):
            node = next(n for n in node.below.values() if not isinstance(n, _Spilled))
        return node

    def insert(self, key: bytes) -> _Leaf | int:
        if self.root is None:
            self.root = self._leaf(key)
            return self.root
        node, path = self.root, []
        while isinstance(node, _Branch):
            path.append(node)
            ahead = node.below.get(_byte(key, node.at))
            if ahead is None:
                break
            node = ahead
        if isinstance(node, _Leaf) and node.key == key:
            return node
        beside = node if isinstance(node, _Leaf) else self._any(path[-1])
        at = first_difference(beside.key, key)
        if isinstance(node, _Spilled) and at >= path[-1].at:
            return node.number
        # The new text leaves the path at ``at``: below the last branch that stands before it.
        above = None
        for branch in path:
            if branch.at > at:
                break
            above = branch
        leaf = self._leaf(key)
        if above is not None and above.at == at:
            above.below[_byte(key, at)] = leaf
            return leaf
        fork = _Branch(at)
        lower = self.root if above is None else above.below[_byte(key, above.at)]
        fork.below[_byte(beside.key, at)] = lower
        fork.below[_byte(key, at)] = leaf
        if above is None:
            self.root = fork
        else:
            above.below[_byte(key, above.at)] = fork
        return leaf

    def _leaf(self, key: bytes) -> _Leaf:
        self.bytes += len(key) + _NODE_BYTES
        self.count += 1
        return _Leaf(key, self.count - 1)

    def leaves(self, node=None) -> Iterator[_Leaf]:
        waiting = [self.root if node is None else node]
        while waiting:
            node = waiting.pop()
            if isinstance(node, _Leaf):
                yield node
            elif isinstance(node, _Branch):
                waiting.extend(node.below.values())

    def _sizes(self) -> dict[int, tuple[int, bool]]:
        """For each node the bytes below it, and whether nothing below is spilled yet."""
        sizes, waiting = {}, [(self.root, False)]
        while waiting:
            node, done = waiting.pop()
            if isinstance(node, _Leaf):
                sizes[id(node)] = (len(node.key) + _NODE_BYTES, True)
            elif isinstance(node, _Spilled):
                sizes[id(node)] = (0, False)
            elif done:
                parts = [sizes[id(n)] for n in node.below.values()]
                sizes[id(node)] = (sum(b for b, _ in parts), all(w for _, w in parts))
            else:
                waiting.append((node, True))
                waiting.extend((n, False) for n in node.below.values())
        return sizes

    def spill(self, target: int) -> Iterator[tuple[int, _Leaf]]:
        """Take out whole subtrees, the heaviest first, until about ``target`` bytes are left: their texts with the
        subtree's number."""
        stuck = False
        while self.bytes > target and not stuck:
            sizes, node, stuck = self._sizes(), self.root, True
            while isinstance(node, _Branch):
                live = [(b, n) for b, n in node.below.items() if not isinstance(n, _Spilled)]
                side, heavy = max(live, key=lambda x: sizes[id(x[1])][0])
                weight, whole = sizes[id(heavy)]
                if whole and len(live) > 1 and (isinstance(heavy, _Leaf) or weight <= max(target, self.bytes - target)):
                    number = self.spills
                    self.spills += 1
                    node.below[side] = _Spilled(number)
                    for leaf in self.leaves(heavy):
                        self.bytes -= len(leaf.key) + _NODE_BYTES
                        yield number, leaf
                    stuck = False
                    break
                node = heavy


_LOCAL = "is_text boolean, row_id long, id long, rep long, size long, digest string, body binary, rows long, first_id long, first_row long"
_SETTLED = "rep long, owner long, spill long, size long, digest string, body binary, rows long, first_id long, first_row long, is_owner boolean"


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"boolean": pa.bool_(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in ddl.split(", "))])


class _Rows:
    """Output rows as record batches of bounded size."""

    def __init__(self, ddl: str, most: int = 8 << 20):
        self.schema, self.most = _arrow(ddl), most
        self.rows, self.held = [], 0

    def add(self, *row) -> pa.RecordBatch | None:
        self.rows.append(row)
        self.held += 100 + sum(len(x) for x in row if isinstance(x, bytes))
        return self.flush() if self.held > self.most else None

    def rest(self) -> list[pa.RecordBatch]:
        return [self.flush()] if self.rows else []

    def flush(self) -> pa.RecordBatch:
        columns = [pa.array(c, t) for c, t in zip(zip(*self.rows), self.schema.types)]
        self.rows, self.held = [], 0
        return pa.RecordBatch.from_arrays(columns, schema=self.schema)


def _order(keep: str):
    """Sort key of (id, row): null ids last, equal ids by row."""
    sign = 1 if keep == "smallest" else -1
    return lambda key_id, row: (_NO_ID if key_id is None else sign * key_id, row, key_id)


def _collapser(keep: str, trie_bytes: int):
    """Rows (row_id, id, body) to one row per member and, for each different text of the task, one with the text."""

    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        out, trie, base, order = _Rows(_LOCAL), Trie(), TaskContext.get().partitionId() << 36, _order(keep)

        def texts():
            for leaf in trie.leaves() if trie.root is not None else ():
                _, row, key_id = leaf.first
                digest = hashlib.sha256(leaf.key).hexdigest()
                yield out.add(True, None, None, base + leaf.number, len(leaf.key), digest, leaf.key, leaf.rows, key_id, row)

        for batch in batches:
            for row_id, key_id, body in zip(*(c.to_pylist() for c in batch.columns)):
                leaf = trie.insert(body)
                leaf.add(1, order(key_id, row_id))
                full = out.add(False, row_id, key_id, base + leaf.number, None, None, None, None, None, None)
                if full is not None:
                    yield full
                if trie.bytes > trie_bytes:
                    yield from filter(None, texts())
                    base += trie.count
                    trie = Trie()
        yield from filter(None, texts())
        yield from out.rest()

    return collapse


def _settler(keep: str, trie_bytes: int, round_number: int):
    """Texts of a partition to their terminal nodes; those of spilled subtrees come out again with the subtree's number."""

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        out, trie, order = _Rows(_SETTLED), Trie(), _order(keep)
        base = (round_number << 56) | (TaskContext.get().partitionId() << 36)
        # What came in with the texts that are in the trie, by terminal node: goes out again should their subtree be spilled.
        members: dict[int, list[tuple]] = {}
        limit = trie_bytes

        def left(number, body, member):
            rep, digest, *known = member
            return out.add(rep, None, base + number, len(body), digest, body, *known, False)

        for batch in batches:
            for body, *member in zip(*(c.to_pylist() for c in batch.columns)):
                node = trie.insert(body)
                if isinstance(node, int):
                    yield from filter(None, [left(node, body, member)])
                    continue
                members.setdefault(node.number, []).append(member)
                if trie.bytes > limit:
                    for number, leaf in trie.spill(trie_bytes // 2):
                        yield from filter(None, [left(number, leaf.key, m) for m in members.pop(leaf.number)])
                    # What cannot be spilled, a text of each branch, does not set off a search at every row.
                    limit = max(trie_bytes, 2 * trie.bytes)
        for leaf in trie.leaves() if trie.root is not None else ():
            owner, held = base + leaf.number, members.pop(leaf.number)
            for rep, _, rows, first_id, first_row in held:
                leaf.add(rows, order(first_id, first_row))
                yield from filter(None, [out.add(rep, owner, None, None, None, None, None, None, None, False)])
            _, row, key_id = leaf.first
            yield from filter(None, [out.add(None, owner, None, len(leaf.key), held[0][1], None, leaf.rows, key_id, row, True)])
        yield from out.rest()

    return settle


def exact_duplicates(
    docs: DataFrame,
    workspace: Workspace,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    normalise: Callable[[Column], Column] | None = None,
    trie_bytes: int = TRIE_BYTES,
    partition_bytes: int = PARTITION_BYTES,
) -> DataFrame:
    """Per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when all bytes of what ``normalise`` makes of them are equal; a null text counts as empty. Of equal texts
    the row with the ``smallest`` or ``largest`` id stays. Ids are integers. A null id stays only if the whole group has none
    (keep_id is then null), and of several rows with the id that stays, the first in reading order does: ``kept`` is true for
    exactly one row of each group. Other columns are not read. An empty table gives an empty result.

    Each map task puts its texts into a trie and passes on every different text once, so a text that is a third of
    all rows comes to its partition as often as there are tasks. Partitions by length and content hash insert what they get
    into a trie of their own, in one pass over a stream. Beyond ``trie_bytes`` they hand whole subtrees to the next round, in which
    every subtree is a partition's key; each round settles part of what it gets. Memory follows ``trie_bytes`` and the
    longest text, not the partition: a text's rows are met one at a time, and the trie has it once.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep is smallest or largest, not {keep}")
    text = F.col(f"`{text_col}`") if normalise is None else normalise(F.col(f"`{text_col}`"))
    rows = numbered(docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text.alias("text")))
    bodies = rows.select("row_id", "id", F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("body"))
    local = workspace.keep(bodies.mapInArrow(_collapser(keep, trie_bytes), _LOCAL), "local")
    waiting = local.where("is_text")
    amount = waiting.agg(F.sum(F.col("size") + _NODE_BYTES)).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-amount // partition_bytes))
    dealt = ["size", F.substring("digest", 1, 16)]
    members, owners, number = [], [], 0
    while True:
        found = workspace.keep(
            waiting.repartition(parts, *dealt)
            .select("body", "rep", "digest", "rows", "first_id", "first_row")
            .mapInArrow(_settler(keep, trie_bytes, number), _SETTLED),
            f"settled-{number}",
        )
        members.append(found.where("owner is not null and not is_owner").select("rep", "owner"))
        owners.append(found.where("is_owner").select("owner", "rows", "digest", "first_id", "first_row"))
        waiting, dealt = found.where("spill is not null"), ["spill"]
        if waiting.isEmpty():
            break
        number += 1
    answers = reduce(DataFrame.unionByName, members).join(reduce(DataFrame.unionByName, owners), "owner").drop("owner")
    return local.where("not is_text").select("rep", "row_id", "id").join(answers, "rep").select(
        "id",
        F.col("first_id").alias("keep_id"),
        F.col("rows").alias("group_size"),
        (F.col("row_id") == F.col("first_row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )
