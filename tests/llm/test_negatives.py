import numpy as np
import pytest
from pyspark.sql import functions as F

from skyweave.llm.negatives import LEVELS, Anchor, Block, best_in_bands, candidates, encoded, hard_negatives, labelled_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, anchor int, terms string, id string"


def vectors_of(seed, n=400, width=24):
    """Clustered vectors with repeated ones, so that scores tie."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, width))
    rows = []
    for i in range(n):
        v = centres[rng.integers(6)] + 0.3 * rng.normal(size=width)
        rows.append((i, (v / np.linalg.norm(v)).astype(np.float32), int(rng.integers(3))))
    return rows + [(n + j, rows[j % 7][1], j % 3) for j in range(60)]


def brute(rows, every=20, share=80, k=5):
    rows = [(i, np.floor(256 * v.astype(np.float64)).astype(np.int64), c) for i, v, c in rows]
    out = []
    for a, s, label in rows:
        if a % every:
            continue
        scored = sorted(((-int(s @ v), i, c) for i, v, c in rows if i != a), key=lambda x: x[:2])
        for p, positive, _ in [x for x in scored if x[2] == label][:k]:
            fit = [x for x in scored if x[2] != label and -share * p <= -100 * x[0] <= -100 * p][:k]
            out += [(a, positive, r, i, -p, -n) for r, (n, i, _) in enumerate(fit, start=1)]
    return sorted(out)


def mined(spark, workspace, rows, every=20, **options):
    frame = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], c, 1, "t", "x") for i, v, c in rows], SCHEMA)
    vectors = labelled_vectors(frame, "vec_id", "embedding", F.col("label"))
    found = hard_negatives(vectors.where(F.col("id") % every == 0), vectors, workspace, **options)
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("width", [1, 8, 64, 100])
def test_intervals_hold_every_score(width):
    rng = np.random.default_rng(width)
    values = np.concatenate([rng.integers(-200, 200, (300, width)), np.zeros((2, width), int), np.full((2, width), 30_000)])
    block = Block(np.arange(len(values)), None, values, *encoded(values))
    widths = []
    for s in (values[0], values[-1], np.zeros(width, int), rng.integers(-5, 5, width)):
        anchor, exact, estimate, rows = Anchor(s), values @ s, np.zeros(len(values)), np.arange(len(values))
        for level in range(LEVELS):
            estimate, half = block.intervals(anchor, level, rows, estimate)
            assert (np.abs(exact - estimate) <= half).all()
            widths.append(half[:300].mean())
    assert width == 1 or widths[LEVELS - 1] < widths[0] / 2


def test_few_rows_are_scored():
    """Even of directions without any clusters most rows leave by their intervals; the answer is that of scoring all."""
    rng = np.random.default_rng(4)
    values = np.floor(256 * rng.normal(size=(3000, 64)) / 8).astype(np.int64)
    block = Block(np.arange(len(values)), None, values, *encoded(values))
    anchor, everything, bands = Anchor(values[5]), np.arange(len(values)), [(-np.inf, np.inf)]
    ((ids, scores),) = best_in_bands(anchor, block, everything, bands, 5)
    exact = values @ values[5]
    expected = sorted(range(len(values)), key=lambda i: (-exact[i], i))[:5]
    assert ids.tolist() == expected and scores.tolist() == exact[expected].tolist()
    assert len(candidates(anchor, block, everything, bands, 5)) < len(values) / 2


@pytest.mark.parametrize("options", [{}, {"cell_bytes": 20_000}])
def test_brute_force(spark, workspace, options):
    rows = vectors_of(1)
    assert mined(spark, workspace, rows, **options) == brute(rows)


def test_odd_rows(spark, workspace):
    rows = [
        (0, [0.5, 0.5], 1), (20, [0.5, 0.5], 1), (1, [0.5, 0.5], 1), (2, [0.4, 0.6], 1), (3, [0.5, 0.5], 2), (4, [0.5, 0.5], 2),
        (5, [0.5, None], 1), (6, [float("nan"), 1.0], 2), (7, [float("inf"), 1.0], 2), (8, None, 2), (9, [1.0, 1.0], None),
        (10, [-0.5, -0.5], 3), (40, [-0.5, -0.5], 4), (41, [0.5, 0.5], 4), (42, [-0.4, -0.4], 4), (60, [], 5), (61, [], 5),
        (None, [0.5, 0.5], 2),
    ]
    usable = [
        (i, np.array([*v, *[0.0] * (2 - len(v))], dtype=np.float32), c) for i, v, c in rows
        if i is not None and v is not None and c is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    assert mined(spark, workspace, rows) == brute(usable)


def test_empty(spark, workspace):
    assert mined(spark, workspace, []) == []


def test_rows_with_one_id(spark, workspace):
    """An anchor that occurs twice answers twice; candidates that occur twice are both ranked."""
    a, b = [0.5, 0.25], [0.5, 0.2]
    got = mined(spark, workspace, [(0, a, 1), (0, a, 1), (1, a, 1), (2, b, 2), (2, b, 2)])
    assert [g[:4] for g in got] == [(0, 1, 1, 2)] * 2 + [(0, 1, 2, 2)] * 2
