"""Forests: splits against plain loops, the same trees however they are grown, storage."""

import itertools

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from skyweave.operators.features import ROW_FEATURES
from skyweave.plans import forest, learning
from skyweave.plans.forest import Nodes, Plan, fit_forest, grow
from skyweave.queries import learning as queries
from skyweave.session import scratch_path

WEIGHTS = np.array([1.0, 2.0, 0.5])


def rows_of(n, seed=3):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(0, 12, n), rng.integers(0, 9, n)
    label = np.where(rng.random(n) < 0.2, rng.integers(0, 3, n), np.where(a < 4, 0, np.where(b < 5, 1, 2)))
    return np.stack([a, b]).astype(np.uint8), label.astype(np.uint8)


def frame(spark, n=3000):
    bins, label = rows_of(n)
    rows = [(float(a), float(b), float(k), float(WEIGHTS[k])) for (a, b), k in zip(bins.T, label)]
    return spark.createDataFrame(rows, "a double, b double, label_index double, class_weight double").repartition(3)


def impurity(label, times):
    mass = np.bincount(label, weights=times, minlength=3) * WEIGHTS
    return mass.sum() - (mass**2).sum() / mass.sum() if mass.sum() else 0.0


def test_every_split_is_the_best_one():
    bins, label = rows_of(400)
    times = np.random.default_rng(5).poisson(1.0, 400)
    made = grow(bins, label, times, Plan(1, 4, 2, 13, WEIGHTS), 0)
    held = {0: np.flatnonzero(times)}
    for node in range(len(made.cut)):
        rows = held[node]
        if made.child[node] == node:
            continue
        own = made.feature[node], made.cut[node]

        def after(f, cut):
            left = rows[bins[f, rows] <= cut]
            right = rows[bins[f, rows] > cut]
            return impurity(label[left], times[left]) + impurity(label[right], times[right])

        least = min(after(f, cut) for f, cut in itertools.product(range(2), range(12)))
        assert after(*own) == pytest.approx(least)
        on_left = bins[own[0], rows] <= own[1]
        held[made.child[node]], held[made.child[node] + 1] = rows[on_left], rows[~on_left]
    assert len(held) == len(made.cut) > 15
    for node, rows in held.items():
        mass = np.bincount(label[rows], weights=times[rows], minlength=3) * WEIGHTS
        assert np.allclose(made.votes[node], forest.WHOLE * mass / mass.sum(), atol=1)


def test_merged_leaves_say_the_same():
    bins, label = rows_of(400)
    made = grow(bins, label, np.ones(400), Plan(1, 8, 1, 13, WEIGHTS), 7)
    small = made.pruned()
    assert len(small.cut) < len(made.cut)
    said = [t.votes[t.find(bins)].argmax(axis=1) for t in (made, small)]
    assert np.array_equal(*said)
    again = Nodes.from_row(*small.to_row(7)[1:])
    assert np.array_equal(again.find(bins), small.find(bins))


@pytest.mark.parametrize("lot", [1, 1 << 30])
def test_trees_grown_from_above_are_the_same(spark, monkeypatch, lot):
    """With a single feature nothing is left to chance but the rows drawn, which are the same either way."""
    df = frame(spark).persist()
    args = (["a"], "label_index", "class_weight", 3, 5, 6)
    whole = fit_forest(df, *args)
    monkeypatch.setattr(forest, "LOCAL_ROWS", 500)
    monkeypatch.setattr(forest, "LOT_BYTES", lot)
    above = fit_forest(df, *args)
    one, two = (m.transform(df).groupBy("a", "prediction").count().orderBy("a").collect() for m in (whole, above))
    assert one == two and sum(r["count"] for r in one) == 3000
    assert whole.size() == above.size()
    assert [spark.read.parquet(m.getOrDefault("nodes")).count() for m in (whole, above)] == [5, 5]
    df.unpersist()


def test_a_forest_from_above_learns(spark, monkeypatch):
    df = frame(spark)
    monkeypatch.setattr(forest, "LOCAL_ROWS", 300)
    model = fit_forest(df, ["a", "b"], "label_index", "class_weight", 3, 15, 8)
    right = model.transform(df).where("prediction = label_index").count()
    assert right > 0.8 * 3000


def test_trees_stay_off_the_driver(spark, folder, monkeypatch):
    """F1: what the driver holds of a forest does not grow with its nodes; a stored copy scores alike."""
    train, held_out = queries.parts(spark, folder)
    sizes = []
    for trees in (3, 12):
        monkeypatch.setattr(learning, "FOREST_TREES", trees)
        model = learning.fit(learning.FOREST, train, ROW_FEATURES)
        stage = next(s for s in model.stages if isinstance(s, forest.Forest))
        assert spark.read.parquet(stage.getOrDefault("nodes")).count() == trees
        sizes.append(len(stage.getOrDefault("state")))
    assert sizes[0] == sizes[1]
    path = scratch_path(spark, "test-forest")
    model.write().overwrite().save(path)
    scored = [learning.score(m, held_out).orderBy("event_id").collect() for m in (model, PipelineModel.load(path))]
    assert scored[0] == scored[1]


def test_an_alias_scores_by_its_own_trees(spark, folder, monkeypatch):
    """a registered forest is loaded without its nodes, which it reads from its own copy."""
    monkeypatch.setattr(learning, "FOREST_TREES", 3)
    train, _ = queries.parts(spark, folder)
    registry = learning.ModelTable(spark, scratch_path(spark, "test-registry"))
    score = spark.createDataFrame([(learning.FOREST, 0.5)], "candidate string, macro_f1 double")
    registry.store("m", {learning.FOREST: learning.fit(learning.FOREST, train, ROW_FEATURES)}, score)
    learning.promote(registry, "m", 1)
    model, _ = registry.load("m", "prod")
    stage = next(s for s in model.stages if isinstance(s, forest.Forest))
    assert stage.getOrDefault("nodes").startswith(registry.root) and stage.size() > 3
