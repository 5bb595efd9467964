import random
import zlib
from collections import Counter

import pytest

from skyweave.llm import spelling
from skyweave.llm.queries.words import _noisy
from skyweave.llm.spelling import neighbours, spelling_variants, word_counts
from skyweave.llm.workspace import Workspace

DOCS = "doc_id long, text string, word string, n int, id string"


def one_apart(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(counts, times=10):
    out = {}
    for w, n in counts.items():
        near = [v for v in counts if one_apart(w, v)]
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        form = best if best is not None and counts[best] >= times * n else None
        out[w] = (n, len(near), form, counts[form] if form else None)
    rows = []
    for w, (n, n_near, form, form_n) in out.items():
        root = w
        while out[root][2]:
            root = out[root][2]
        rows.append((w, n, n_near, form, form_n, root))
    return sorted(rows)


def vocabulary(seed):
    """Words and variants of variants over a small alphabet, with repeats of letters and shared prefixes and suffixes."""
    rng = random.Random(seed)
    letters = "abé" if seed % 2 else "abcdefghij"
    words = set()
    for _ in range(60):
        word = "".join(rng.choice(letters) for _ in range(rng.randint(4, 12)))
        if rng.random() < 0.3:
            word = "prefix" + word
        words.add(word)
        for _ in range(4):
            at, kind = rng.randrange(len(word) + 1), rng.randrange(3)
            put = "" if kind == 0 else rng.choice(letters)
            changed = word[:at] + put + word[at + (kind < 2) :]
            if len(changed) >= 4:
                words.add(changed)
                word = changed if rng.random() < 0.4 else word
    words |= {"a" * n for n in range(4, 15)} | {"ab" * n for n in range(2, 9)}
    return {w: int(10 ** rng.uniform(0, 5)) for w in sorted(words)}


@pytest.mark.parametrize("seed", [1, 2])
def test_brute_force(spark, workspace, seed):
    counts = vocabulary(seed)
    found = spelling_variants(spark.createDataFrame(list(counts.items()), "word string, n long"), workspace)
    got = sorted(tuple(r) for r in found.select("word", "n", "n_near", "form", "form_n", "root").collect())
    assert got == brute(counts)


def test_rounds_follow_forks_not_lengths(spark, workspace):
    """Two words of 3000 letters take as few rounds as short ones."""
    long = "".join(random.Random(1).choice("abcd") for _ in range(3000))
    words = [long, long[:1700] + long[1701:], long[:100] + "x" + long[101:], "short", "shirt"]
    pairs = neighbours(spark.createDataFrame([(w,) for w in words], "word string"), workspace)
    got = {tuple(r) for r in pairs.collect()}
    assert got == {(a, b) for a in words for b in words if one_apart(a, b)}
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{workspace.path}/states-6")
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def test_states_grow_with_the_words(spark, workspace):
    """Words that share a long prefix and part at one place: no state per pair beyond the pairs there are."""
    rng = random.Random(9)
    words = sorted({"commonprefix" + "".join(rng.choice("abcdefghijklmnop") for _ in range(8)) for _ in range(3000)})
    pairs = neighbours(spark.createDataFrame([(w,) for w in words], "word string"), workspace)
    assert {tuple(r) for r in pairs.collect()} == {(a, b) for a in words for b in words if a[:13] == b[:13] and one_apart(a, b)} | {
        (a, b) for a in words for b in words if a[-6:] == b[-6:] and one_apart(a, b)
    }
    states = spark.read.parquet(f"{workspace.path}/states-1").count()
    assert states < 30 * len(words)


def test_counts(spark):
    texts = [
        (1, "Straße straße STRASSE naïveté naïveté", None, 1, "x"),
        (2, None, "w", 1, "x"),
        (3, "", "w", 1, "x"),
        (None, "abcdefg-abcdefg abcdefgh " + "longlonglong " * 50_000, "w", 1, "x"),
        (1, "Straße straße STRASSE naïveté naïveté", None, 1, "x"),
    ]
    docs = spark.createDataFrame(texts, DOCS)
    got = {r.word: r.n for r in word_counts(docs).collect()}
    assert got == {"strasse": 2, "naïveté": 4, "abcdefg": 2, "longlonglong": 50_000}
    assert word_counts(docs.limit(0)).count() == 0

    def plain(doc_id, run):
        h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
        return run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run

    words = ["abcdefgh", "naïvetés", "qwertyuiop"]
    many = spark.createDataFrame([(i, " ".join(words)) for i in range(300)], "doc_id long, text string")
    expected = Counter(w for i in range(300) for w in (plain(i, x) for x in words) if len(w) >= 7)
    got = {r.word: r.n for r in word_counts(many, min_count=1, change=_noisy).collect()}
    assert got == expected and len(got) > 10


def test_nothing_to_compare(spark, workspace):
    frame = lambda rows: spark.createDataFrame(rows, "word string, n long")
    names = ["word", "n", "n_near", "form", "form_n", "root"]
    assert spelling_variants(frame([]), workspace).select(names).collect() == []
    rows = [("alone", 3), (None, 4)]
    got = spelling_variants(frame(rows), Workspace(spark, "alone")).select(names).collect()
    assert [tuple(r) for r in got] == [("alone", 3, 0, None, None, "alone")]
    with pytest.raises(ValueError):
        spelling.spelling_variants(frame(rows), workspace, times=1)
