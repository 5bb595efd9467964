import hashlib
import random
from collections import defaultdict

import pytest

from skyweave.llm import exactdup
from skyweave.llm.exactdup import Trie, exact_duplicates, first_difference

SCHEMA = "doc_id long, text string, rep string, owner int, size int"


def expected(rows, keep):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        best = (max if keep == "largest" else min)(known) if known else None
        digest = hashlib.sha256(text.encode()).hexdigest()
        first = True
        for i in sorted(ids, key=lambda i: i != best):
            out.append((i, best, len(ids), first, digest))
            first = False
    return sorted(out, key=repr)


def found(spark, workspace, rows, **options):
    docs = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], SCHEMA).repartition(5)
    return sorted((tuple(r) for r in exact_duplicates(docs, workspace, **options).collect()), key=repr)


def test_first_difference():
    rng = random.Random(3)
    for _ in range(2000):
        a = bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 300)))
        b = bytearray(a[: rng.randint(0, len(a))] + bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 5))))
        if bytes(b) == a:
            continue
        at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert first_difference(a, bytes(b)) == at


@pytest.mark.parametrize("alphabet, longest", [(b"ab", 6), (b"abc", 40), (bytes(range(256)), 3)])
def test_trie_holds_each_text_once(alphabet, longest):
    rng = random.Random(longest)
    trie, nodes = Trie(), {}
    for _ in range(3000):
        key = bytes(rng.choice(alphabet) for _ in range(rng.randint(0, longest)))
        node = trie.insert(key)
        assert node.key == key and nodes.setdefault(key, node) is node
    assert sorted(leaf.key for leaf in trie.leaves()) == sorted(nodes)


def test_spilled_subtrees_take_their_later_texts():
    """A text goes to one subtree's number whether it comes before or after the spill, and to one only."""
    rng = random.Random(5)
    keys = [bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 12))) for _ in range(4000)]
    trie, places = Trie(), defaultdict(set)
    for key in keys:
        node = trie.insert(key)
        if isinstance(node, int):
            places[key].add(node)
        if trie.bytes > 200_000:
            for number, leaf in trie.spill(100_000):
                places[leaf.key].add(number)
    held = {leaf.key for leaf in trie.leaves()}
    assert trie.spills > 1 and held and len(held) == sum(1 for _ in trie.leaves())
    assert all(len(p) == 1 for p in places.values())
    assert held.isdisjoint(places) and held | set(places) == set(keys)


def corpus():
    rng = random.Random(7)
    texts = ["", None, "a", "ab", "abc", "é", "é", "x" * 200_000, "x" * 199_999 + "y", " a", "A"]
    texts += ["".join(rng.choice("ab") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    texts += ["hot text"] * 300
    return [(None if i % 97 == 0 else i % 400, rng.choice(texts)) for i in range(900)]


@pytest.mark.parametrize("keep", ["smallest", "largest"])
@pytest.mark.parametrize("trie_bytes", [exactdup.TRIE_BYTES, 4000])
def test_brute_force(spark, workspace, keep, trie_bytes):
    """The small bound makes map tasks pass on several tries and partitions spill over several rounds."""
    rows = corpus()
    got = found(spark, workspace, rows, keep=keep, trie_bytes=trie_bytes, partition_bytes=10**9)
    assert got == expected(rows, keep)


def test_only_null_ids_and_empty_table(spark, workspace):
    got = found(spark, workspace, [(None, "a"), (None, "a"), (None, None)])
    assert got == expected([(None, "a"), (None, "a"), (None, None)], "smallest")
    empty = exact_duplicates(spark.createDataFrame([], SCHEMA), type(workspace)(spark, "none"))
    assert empty.columns == ["id", "keep_id", "group_size", "kept", "text_sha256"] and empty.count() == 0


def test_normalised(spark, workspace):
    from pyspark.sql import functions as F

    got = found(spark, workspace, [(1, "A b"), (2, "a B"), (3, "ab")], normalise=F.lower, keep="largest")
    assert [(r[0], r[1], r[3]) for r in got] == [(1, 2, False), (2, 2, True), (3, 3, True)]
    with pytest.raises(ValueError):
        found(spark, workspace, [(1, "a")], keep="first")
