"""Mixture, packing and search."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyweave.llm import mixture, packing, topk
from skyweave.llm.mixture import Schedule, arranged, mixed, position
from skyweave.llm.packing import Lengths, best_fit, packed

SCHEMA = "doc_id long, text string, source string, target string, cell int"


def filled(sizes):
    """Targets by resharing the excess until none is above."""
    names = sorted((n for n in sizes if n is not None)) + [n for n in sizes if n is None]
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [n for n in names if n not in fixed]
        rest, heavy = total - sum(fixed.values()), sum(weight[n] for n in free)
        share = {n: rest * weight[n] / heavy for n in free}
        above = [n for n in free if share[n] > 3 * sizes[n]]
        if not above:
            return {**fixed, **share}
        fixed |= {n: 3.0 * sizes[n] for n in above}


def mixture_rows(seed=3):
    rng = random.Random(seed)
    sources = ["a"] * 60 + ["b", "c", "é", "\U0001f600", None] * 3 + ["z"]
    rows = [(i, "w " * rng.randint(0, 60), rng.choice(sources), "x", 1) for i in range(600)]
    return rows + [(None, None, "b", "x", 1), (None, None, "b", "x", 1), (7, "w w", None, "x", 1), (7, "w w", None, "x", 1)]


def test_targets_and_takes(spark, workspace, monkeypatch):
    monkeypatch.setattr(mixture, "CELL_ROWS", 16)
    rows = mixture_rows()
    found = mixed(spark.createDataFrame(rows, SCHEMA), workspace, kept_cols=["target", "cell"]).collect()
    sizes, taken = {}, {}
    for _, text, source, *_ in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    for r in found:
        taken[r.source] = taken.get(r.source, 0) + r.taken
        assert r.taken == r.size * r.copies <= 3 * r.size and len(r.positions) == r.copies
        assert r.source_size == sizes[r.source] and all(0 <= p <= 1 for p in r.positions)
    goal = filled(sizes)
    assert len(found) == len(rows)
    assert all(math.isclose(r.target, goal[r.source], rel_tol=1e-9) for r in found)
    assert all(abs(taken[s] - goal[s]) <= 60 for s in sizes)
    assert math.isclose(sum(goal.values()), sum(sizes.values()))


def test_reruns_agree(spark, workspace):
    rows = mixture_rows(4)
    df = spark.createDataFrame(rows, SCHEMA)
    one = sorted((str(r.doc_id), r.taken) for r in mixed(df.repartition(7), workspace).collect())
    two = sorted((str(r.doc_id), r.taken) for r in mixed(df.repartition(2), workspace.__class__(spark, "t")).collect())
    assert one == two


def test_curriculum(spark, workspace):
    """Early in the training the falling source gives more than its share, late the rising one."""
    rows = [(i, "w " * 10, "abc"[i % 3], "x", 1) for i in range(3000)]
    copies = [(r.position, r.source) for r in arranged(mixed(spark.createDataFrame(rows, SCHEMA), workspace)).collect()]
    assert [p for p, _ in copies] == sorted(p for p, _ in copies)
    early = [s for p, s in copies if p < 0.25]
    late = [s for p, s in copies if p > 0.75]
    assert early.count("a") / len(early) > 1.2 * late.count("a") / len(late)
    assert late.count("c") / len(late) > 1.5 * early.count("c") / len(early)


def test_position_inverts_the_integral(spark):
    schedule = Schedule()
    df = spark.range(101).select((F.col("id") / 100.0).alias("d")).withColumn("kind", F.explode(F.array(*map(F.lit, (0, 1, 2)))))
    for r in df.withColumn("t", position(F.col("kind"), F.col("d"), schedule)).collect():
        area = 0.0
        for t0, t1, w0, slope, _ in schedule.segments(r.kind):
            x = max(0.0, min(r.t, t1) - t0)
            area += w0 * x + slope * x * x / 2
        assert math.isclose(area, r.d, abs_tol=1e-9)


def test_mixture_without_words(spark, workspace):
    df = spark.createDataFrame([(1, None, "a", "x", 1), (2, "", None, "x", 1)], SCHEMA)
    assert [(r.target, r.copies, r.taken) for r in mixed(df, workspace).collect()] == [(0.0, 0, 0)] * 2
    assert mixed(df.limit(0), workspace.__class__(spark, "t")).count() == 0


def plain_best_fit(sizes, lengths):
    """The same rule by looking at every bin."""
    bins, left = [], sum(sizes)
    for turn, size in enumerate(sorted(sizes, reverse=True)):
        open_ = [b for b in bins if b[0] - sum(b[1]) >= size]
        if open_:
            # Of bins with the same room, the one filled last.
            chosen = min(open_, key=lambda b: (b[0] - sum(b[1]), -b[2]))
        else:
            fits = [c for c in lengths.permitted if c >= size]
            chosen = [min(fits, key=lambda c: (lengths.cost(c) / min(c, left), c)), [], turn]
            bins.append(chosen)
        chosen[1].append(size)
        chosen[2] = turn
        left -= size
    return sorted((min(c for c in lengths.permitted if c >= sum(x)), sum(x)) for _, x, _ in bins)


@pytest.mark.parametrize("seed", range(12))
def test_best_fit(seed):
    rng = np.random.default_rng(seed)
    lengths = Lengths((8, 16, 32, 64), fixed=float(seed), square=500.0)
    sizes = rng.integers(1, 65, int(rng.integers(0, 120)))
    bins, offsets, final = best_fit(sizes, lengths)
    used = np.bincount(bins, weights=sizes, minlength=len(final)).astype(int) if len(final) else []
    assert sorted(zip(final, map(int, used))) == plain_best_fit(sizes.tolist(), lengths)
    for b in range(len(final)):
        spans = sorted((int(o), int(o + s)) for o, s in zip(offsets[bins == b], sizes[bins == b]))
        assert spans[0][0] == 0 and spans[-1][1] == used[b] <= final[b]
        assert all(x[1] == y[0] for x, y in zip(spans, spans[1:]))


def test_packing_loses_nothing(spark, workspace):
    rows = [(i % 90, s, "x") for i, s in enumerate([0, 1, 5, 64, 65, 200, None] * 20)] + [(None, 12, "x")]
    lengths = Lengths((8, 16, 32, 64))
    found = packed(spark.createDataFrame(rows, "doc_id long, size long, shard string"), workspace, lengths, 16).collect()
    by = {}
    for r in found:
        by.setdefault(r.row_id, []).append(r)
    assert len(by) == len(rows)
    assert sorted((sum(p.length for p in x), str(x[0].doc_id)) for x in by.values()) == sorted((s or 0, str(d)) for d, s, _ in rows)
    bins = {}
    for r in found:
        if r.bin_id is not None:
            bins.setdefault((r.bin_id, r.capacity), []).append((r.offset, r.offset + r.length))
    assert len({b for b, _ in bins}) == len(bins)
    for (_, capacity), spans in bins.items():
        spans.sort()
        assert spans[0][0] == 0 and spans[-1][1] <= capacity and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    for pieces in by.values():
        pieces.sort(key=lambda p: p.piece)
        assert all(p.start == 64 * p.piece for p in pieces)
    assert packed(spark.createDataFrame([], "doc_id long, size long"), workspace.__class__(spark, "t")).count() == 0


VECTORS = "vec_id long, embedding array<float>, terms string, score int"


def exact(rows, k):
    out = []
    good = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    for i, q in good:
        if i % 20 == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in good if j != i)[:k]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scores)]
    return sorted(out)


@pytest.mark.parametrize("cell", [7, 100_000])
def test_search(spark, workspace, cell):
    rng = np.random.default_rng(6)
    rows = [(i, [float(np.float32(x)) for x in np.round(rng.normal(size=6) * 4) / 8]) for i in range(160)]
    rows += [(200, None), (220, [None, 1.0]), (240, [float("nan")] * 6), (260, [float("inf")] * 6), (None, [1.0] * 6), (280, []), (281, [0.5, 0.25])]
    rows += [(300 + i, [1.0, 0.0, 0.5, 0.0, 0.0, -1.0]) for i in range(30)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], VECTORS)
    vectors = topk.quantised(df, "vec_id", "embedding")
    found = topk.top_k(vectors.where("id % 20 = 0"), vectors, 20, workspace, block_rows=5, cell_rows=cell)
    assert sorted(tuple(r) for r in found.collect()) == exact(rows, 20)


def test_search_of_large_numbers_and_nothing(spark, workspace):
    rows = [(20, [3.0e7, -2.0e7]), (21, [4.0e7, 5.0e6]), (22, [-1.0e7, 9.0e6])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], VECTORS)
    vectors = topk.quantised(df, "vec_id", "embedding")
    found = topk.top_k(vectors.where("id % 20 = 0"), vectors, 20, workspace)
    assert sorted(tuple(r) for r in found.collect()) == exact(rows, 20)
    nothing = topk.top_k(vectors.limit(0), vectors, 20, workspace.__class__(spark, "t"))
    assert nothing.count() == 0
