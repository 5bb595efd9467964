import random

import numpy as np
import pyarrow as pa

from skyweave.llm import neardup
from skyweave.llm.graph import components
from skyweave.llm.neardup import Similarity, estimated, merged, near_duplicates, one_of_each, registers
from skyweave.llm.tokens import shingles, words

SCHEMA = "doc_id long, text string, row_id string, bucket int"


def sets_of(texts, how):
    out = []
    for t in texts:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        for c in "\t\n\x0b\x0c\r":
            lowered = lowered.replace(c, " ")
        w = [x for x in lowered.split(" ") if x]
        n = how.shingle
        out.append({tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    return out


def brute(rows, how):
    """Component of each row by comparing all pairs of sets."""
    sets = sets_of([t for _, t in rows], how)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= how.percent * len(a | b):
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    least = {g: min((x for x in ids if x is not None), default=None) for g, ids in groups.items()}
    return sorted(
        (d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows) if d is not None
    )


def corpus(seed, groups=12, copies=25):
    """Loose groups of copies: some pairs are linked, some only through others, some not at all."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(groups):
        text = [rng.choice(vocabulary) for _ in range(rng.randint(1, 90))]
        for _ in range(copies):
            changed = list(text)
            for _ in range(rng.randint(0, 4)):
                changed[rng.randrange(len(changed))] = rng.choice(vocabulary)
            texts.append(" ".join(changed))
            if rng.random() < 0.2:
                texts.append(texts[-1].upper().replace(" ", "\t\n"))
    return [(i, t) for i, t in enumerate(texts)]


def result(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in df.where("doc_id is not null").collect())


def test_against_all_pairs(spark, workspace):
    rows = corpus(1) + [(9001, None), (9002, ""), (9003, " \n"), (9004, "one"), (9005, "ONE"), (9006, "one two")]
    for how in (Similarity(3, 85), Similarity(5, 80)):
        df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
        assert result(near_duplicates(df, workspace.__class__(spark, "t"), how)) == brute(rows, how)


def test_many_rounds(spark, workspace, monkeypatch):
    monkeypatch.setattr(neardup, "SLOTS", (1, 2))
    monkeypatch.setattr(neardup, "BLOCK", 7)
    rows, how = corpus(2, groups=4, copies=40), Similarity(3, 85)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(near_duplicates(df, workspace, how)) == brute(rows, how)


def test_null_and_repeated_rows(spark, workspace):
    rows = [(None, "a b c d"), (7, "a b c d"), (7, "a b c d"), (3, None), (3, None), (None, "z z z z")]
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), workspace).collect()
    assert len(found) == 6
    by = {(r.doc_id, r.n_shingles): r for r in found}
    assert by[(7, 1)].component_id == 7 and by[(7, 1)].kept and by[(3, 0)].component_id == 3
    lonely = [r for r in found if r.doc_id is None]
    assert sorted((r.component_id is None, r.kept) for r in lonely) == [(False, False), (True, True)]


def test_empty(spark, workspace):
    df = spark.createDataFrame([], "doc_id long, text string, cls int")
    assert near_duplicates(df, workspace).count() == 0
    assert one_of_each(df, workspace.__class__(spark, "t")).columns == df.columns


def test_one_of_each(spark, workspace):
    rows = corpus(3, groups=5, copies=12) + [(500, ""), (501, None), (0, None)]
    how = Similarity(5, 80)
    kept = one_of_each(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA), workspace, how)
    assert kept.columns == ["doc_id", "text", "row_id", "bucket"]
    expected = sorted(d for d, n, c in brute(rows, how) if d == c)
    assert sorted(r.doc_id for r in kept.collect()) == expected


def test_estimate_follows_similarity():
    how = Similarity()
    rng = np.random.default_rng(4)
    errors = []
    for share in (0.3, 0.6, 0.8, 0.9):
        common, own = int(1000 * share), 1000 - int(1000 * share)
        pool = rng.integers(0, 2**63, common + 2 * own, dtype=np.uint64)
        a, b = np.sort(pool[: common + own]), np.sort(np.concatenate((pool[:common], pool[common + own :])))
        x = registers(a, np.zeros(len(a), int), 1, how)
        y = registers(b, np.zeros(len(b), int), 1, how)
        true = common / len(np.union1d(a, b))
        got = estimated(x, y, np.array([len(a)]), np.array([len(b)]), how.base)[0]
        errors.append(abs(got - true))
        joint = np.union1d(a, b)
        assert (merged(x, y) == registers(joint, np.zeros(len(joint), int), 1, how)).all()
    assert max(errors) < 4 * (0.25 / how.registers) ** 0.5


def test_shingles_of_unusual_texts():
    column = pa.array(["", "a", "A  b", "a b c a b c a b c", "\xa0 é é", "x" * 100_000], pa.large_string())
    value, row = shingles(words(column, lower=True), 3)
    assert np.bincount(row, minlength=6).tolist() == [0, 1, 1, 3, 1, 1]


def test_components(spark, workspace):
    chain = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 200), (5, 5)]
    found = components(spark.createDataFrame(chain, "a long, b long"), workspace)
    got = {r.node: r.root for r in found.collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long"), workspace, "none").count() == 0
