"""Boosted trees: bins, one round against plain loops, quality, storage, odd input."""

import json
import pickle

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from skyweave.plans import boosting
from skyweave.plans.boosting import BoostedTrees, Growth, Tree, bin_edges, binned, fit_boosting
from skyweave.session import scratch_path

SCHEMA = "id long, a double, b double, label_index double, class_weight double"


def rows_of(n, seed=1):
    """Three classes by two features, with nulls and NaN that tell something, and ties."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        a, b = float(np.round(rng.normal(), 2)), float(rng.integers(0, 40))
        label = 0 if a < -0.3 else 1 if b < 22 else 2
        if label == 2 and rng.random() < 0.3:
            a = None if rng.random() < 0.5 else float("nan")
        rows.append((i, a, b, float(label), 1.0 + label))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def missing(x):
    return x is None or np.isnan(x)


def plain_round(rows, growth, bins):
    """The first round's trees by loops over rows: for each class a dict of node -> (feature, cut, last_left) and leaf values."""
    columns = [[r[1] for r in rows], [r[2] for r in rows]]
    edges = []
    for column in columns:
        seen = np.sort([v for v in column if not missing(v)])
        edges.append(sorted({float(np.quantile(seen, i / bins)) for i in range(1, bins)}))
    codes = [
        [len(e) + 1 if missing(v) else sum(1 for c in e if c <= v) for v in column] for column, e in zip(columns, edges)
    ]
    mass = np.zeros(3)
    for r in rows:
        mass[int(r[3])] += r[4]
    start = mass / mass.sum()
    out = []
    for k in range(3):
        g = [r[4] * (start[k] - (r[3] == k)) for r in rows]
        h = [r[4] * start[k] * (1 - start[k]) for r in rows]
        at, splits, values = [0] * len(rows), {}, {}
        for level in range(growth.depth):
            for node in range(2**level - 1, 2 ** (level + 1) - 1):
                mine = [i for i, x in enumerate(at) if x == node]
                total = (sum(g[i] for i in mine), sum(h[i] for i in mine))
                best, choice = 1e-9, None
                for f in range(2):
                    last = len(edges[f]) + 1
                    sides = (False, True) if any(codes[f][i] == last for i in mine) else (False,)
                    for last_left in sides:
                        for cut in range(last):
                            left = [i for i in mine if (last_left if codes[f][i] == last else codes[f][i] <= cut)]
                            gl, hl = sum(g[i] for i in left), sum(h[i] for i in left)
                            gr, hr = total[0] - gl, total[1] - hl
                            if min(len(left), len(mine) - len(left)) < growth.least_rows or min(hl, hr) < growth.least_curvature:
                                continue
                            gain = gl**2 / hl + gr**2 / hr - total[0] ** 2 / total[1]
                            if gain > best + 1e-9:
                                best, choice = gain, (f, cut, last_left, set(left), gl, hl, gr, hr)
                if choice is None:
                    for i in mine:
                        at[i] = 2 * node + 1
                    if mine:
                        values[2 * node + 1] = -growth.rate * total[0] / total[1]
                    continue
                f, cut, last_left, left, gl, hl, gr, hr = choice
                splits[node] = (f, cut, last_left)
                values[2 * node + 1], values[2 * node + 2] = -growth.rate * gl / hl, -growth.rate * gr / hr
                for i in mine:
                    at[i] = 2 * node + (1 if i in left else 2)
        out.append((splits, values, at))
    return out


def test_one_round_is_that_of_plain_loops(spark):
    rows, growth = rows_of(400), Growth(depth=3, least_rows=5)
    model = fit_boosting(frame(spark, rows), ["a", "b"], "label_index", "class_weight", 3, 1, growth, bins=12)
    state = json.loads(model.getOrDefault(model.state))
    for tree_parts, (splits, values, at) in zip(state["trees"][0], plain_round(rows, growth, 12)):
        tree = Tree.from_json(tree_parts)
        found = {i: (int(f), int(c), bool(s)) for i, (f, c, s) in enumerate(zip(tree.feature, tree.cut, tree.last_left)) if f >= 0}
        assert found == splits
        for node in set(at):
            assert tree.value[node] == pytest.approx(values[node], rel=1e-9)


def test_rounds_reduce_the_errors_and_blocks_do_not_matter(spark, monkeypatch):
    rows = rows_of(1500)
    df = frame(spark, rows)
    scores = []
    for rounds, block_rows, partials in ((1, 32_768, 64), (5, 32_768, 64), (5, 100, 2)):
        monkeypatch.setattr(boosting, "BLOCK_ROWS", block_rows)
        monkeypatch.setattr(boosting, "PARTIALS", partials)
        model = fit_boosting(df, ["a", "b"], "label_index", "class_weight", 3, rounds)
        found = {r.id: (r.prediction, r.margins) for r in model.transform(df).collect()}
        scores.append((sum(found[r[0]][0] == r[3] for r in rows) / len(rows), found))
    assert scores[1][0] >= scores[0][0] and scores[1][0] > 0.99
    for i in scores[1][1]:
        assert np.allclose(scores[1][1][i][1], scores[2][1][i][1], atol=1e-6)


def test_a_worker_without_earlier_margins_makes_them(spark):
    """Margins of a block are the same whether they were kept or not."""
    rng = np.random.default_rng(0)
    bins, last = rng.integers(0, 4, (2, 50)), np.array([3, 3])
    trees = []
    for _ in range(3):
        tree = Tree.empty(2)
        tree.feature[:], tree.cut[:], tree.value[:] = rng.integers(0, 2, 3), rng.integers(0, 3, 3), rng.normal(size=7)
        trees.append([tree, tree])
    start = np.array([0.1, -0.2])
    boosting._seen.clear()
    whole = boosting._block_margins("x", 1, boosting.packed(trees), start, bins, last)
    boosting._seen.clear()
    for n in range(4):
        step = boosting._block_margins("x", 1, boosting.packed(trees[:n]), start, bins, last)
    assert np.allclose(whole, step)
    # An earlier round, as after a lost executor.
    again = boosting._block_margins("x", 1, boosting.packed(trees[:1]), start, bins, last)
    assert np.allclose(again, boosting.margins(trees[:1], start, bins, last))


def test_model_is_stored_and_streams(spark):
    df = frame(spark, rows_of(300))
    model = fit_boosting(df, ["a", "b"], "label_index", "class_weight", 3, 3)
    path = scratch_path(spark, "boosted")
    PipelineModel([model]).write().overwrite().save(path)
    again = PipelineModel.load(path)
    assert isinstance(again.stages[0], BoostedTrees)
    before = {r.id: r.margins for r in model.transform(df).collect()}
    assert {r.id: r.margins for r in again.transform(df).collect()} == before
    source = scratch_path(spark, "boosted-source")
    df.write.parquet(source)
    stream = again.transform(spark.readStream.schema(df.schema).parquet(source)).select("id", "prediction")
    run = stream.writeStream.format("memory").queryName("boosted").trigger(availableNow=True).start()
    run.awaitTermination()
    assert spark.table("boosted").count() == 300


def test_bins(spark):
    df = frame(spark, [(i, v, 1.0, 0.0, 1.0) for i, v in enumerate([1.0, 2.0, 3.0, 4.0, None, float("nan"), float("inf"), -float("inf")])])
    edges = bin_edges(df, ["a", "b"], 4)
    assert edges["b"] == [1.0] and edges["a"] == [1.25, 2.5, 3.75]
    found = {r.id: (r.a_bin, r.b_bin) for r in binned(df, edges).collect()}
    assert [found[i][0] for i in range(8)] == [0, 1, 2, 3, 4, 4, 3, 0]
    assert {b for _, b in found.values()} == {1}
    nothing = df.withColumn("a", F.lit(None).cast("double"))
    assert bin_edges(nothing, ["a"], 4) == {"a": []}
    assert {r.a_bin for r in binned(nothing, {"a": []}).collect()} == {1}


def test_empty_and_single_class(spark):
    empty = fit_boosting(frame(spark, []), ["a", "b"], "label_index", "class_weight", 2, 3)
    df = frame(spark, [(i, float(i), None, 0.0, 1.0) for i in range(50)])
    assert {r.prediction for r in empty.transform(df).collect()} == {0.0}
    single = fit_boosting(df, ["a", "b"], "label_index", "class_weight", 1, 2)
    assert {r.prediction for r in single.transform(df).collect()} == {0.0}


def test_only_splits_reach_the_driver(spark, monkeypatch):
    """Neither the number of tasks nor the size of the sums bears on what a level sends to the driver."""
    sent, set_splits = [], boosting._set_splits

    def measured(found, growing, level):
        sent.append(len(pickle.dumps(found)))
        set_splits(found, growing, level)

    monkeypatch.setattr(boosting, "_set_splits", measured)
    monkeypatch.setattr(boosting, "STORE_ROUNDS", 1)
    rows = rows_of(1500)
    scores = []
    for tasks in (1, 3):
        df = frame(spark, rows).repartition(tasks)
        model = fit_boosting(df, ["a", "b"], "label_index", "class_weight", 3, 3)
        found = {r.id: r.margins for r in model.transform(df).collect()}
        scores.append(found)
    assert len(sent) == 30 and max(sent) < 10_000
    for i in scores[0]:
        assert np.allclose(scores[0][i], scores[1][i], atol=1e-6)
