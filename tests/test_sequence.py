"""Sliced scans against brute force, with hot keys, crowded instants, null keys and null times."""

import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from skyweave import session
from skyweave.operators import quantiles, sequence
from skyweave.operators.quantiles import exact_quantiles
from skyweave.operators.sequence import as_of, ordered_scan, plan_slices, trailing_sums

START = datetime(2024, 3, 1)


def skewed_rows(seed: int):
    """A third of the rows in one key, a third at one instant, plus null keys and null times."""
    rng = random.Random(seed)
    rows = []
    for i in range(600):
        key = "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", None])
        at = START + timedelta(seconds=rng.randrange(5000))
        if i % 3 == 1:
            at = START + timedelta(seconds=777)
            key = "hot"
        if i % 29 == 0:
            at = None
        value = None if i % 7 == 0 else rng.randrange(100)
        rows.append((i, key, at, value))
    rng.shuffle(rows)
    return rows


SCHEMA = "id bigint, key string, at timestamp_ntz, value bigint"


def ordered(rows, key, reverse=False):
    chosen = [r for r in rows if r[1] == key]
    return sorted(chosen, key=lambda r: (r[2] is not None, r[2] or START, r[0]), reverse=reverse)


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("target", [10_000, 40, 7])
def test_scan_matches_brute_force(spark, target, descending):
    rows = skewed_rows(target)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    slices = plan_slices(df, "at", "id", target)
    assert slices.single == (target == 10_000)
    if target == 7:
        assert slices.heavy and slices.tie_cuts
    got = ordered_scan(
        df,
        ["key"],
        "at",
        "id",
        previous={"was": F.col("value")},
        running={"total": F.col("value")},
        latest={"seen": F.col("value")},
        totals={"n": F.lit(1)},
        descending=descending,
        slices=slices,
    ).collect()
    assert len(got) == len(rows)
    by_id = {r.id: r for r in got}
    for key in ("hot", "a", "b", "c", None):
        track = ordered(rows, key, descending)
        was, total, seen = None, None, None
        for row in track:
            if row[3] is not None:
                total = (total or 0) + row[3]
            found = by_id[row[0]]
            assert (found.was, found.total, found.seen, found.n) == (was, total, seen, len(track)), row
            was = row[3]
            seen = row[3] if row[3] is not None else seen


def test_no_slice_holds_much_more_than_its_share(spark):
    rows = skewed_rows(3)
    df = spark.createDataFrame(rows, SCHEMA)
    slices = plan_slices(df, "at", "id", 30)
    parts = math.ceil(len(rows) / 30)
    placed = sequence._with_slice(df, "at", "id", slices)
    largest = placed.groupBy("key", sequence._SLICE).count().agg(F.max("count")).first()[0]
    assert largest <= 3 * len(rows) / parts


@pytest.mark.parametrize("target", [10_000, 25])
def test_trailing_sums(spark, target, monkeypatch):
    monkeypatch.setattr(sequence, "TARGET_ROWS", target)
    rows = [r for r in skewed_rows(5) if r[2] is not None and r[1] is not None]
    df = spark.createDataFrame(rows, SCHEMA)
    got = trailing_sums(df, ["key"], "at", 600, {"n": F.lit(1), "s": F.coalesce("value", F.lit(0))}).collect()
    expected = set()
    for _, key, at, _ in rows:
        inside = [r for r in rows if r[1] == key and at - timedelta(seconds=600) <= r[2] <= at]
        expected.add((key, at, len(inside), sum(r[3] or 0 for r in inside)))
    assert {(r.key, r.at, r.n, r.s) for r in got} == expected
    assert len(got) == len(expected)


@pytest.mark.parametrize("target", [10_000, 25])
def test_as_of_is_strict(spark, target, monkeypatch):
    monkeypatch.setattr(sequence, "TARGET_ROWS", target)
    rows = [r for r in skewed_rows(6) if r[2] is not None and r[1] is not None]
    versions = sorted({(r[1], r[2]) for r in rows if r[0] % 5 == 0})
    offered = [(k, at, i) for i, (k, at) in enumerate(versions)]
    df = spark.createDataFrame(rows, SCHEMA)
    table = spark.createDataFrame(offered, "key string, known timestamp_ntz, version bigint")
    got = as_of(df, table, ["key"], "at", "known", ["version"], "id").collect()
    assert len(got) == len(rows)
    for r in got:
        older = [(known, v) for k, known, v in offered if k == r.key and known < r.at]
        assert r.version == (max(older)[1] if older else None)


@pytest.mark.parametrize("target, whole, broadcast", [(1_000_000, 20_000, 10_000), (20, 0, 10_000), (20, 20_000, 1)])
def test_exact_quantiles(spark, target, whole, broadcast, monkeypatch):
    import numpy as np

    monkeypatch.setattr(session, "BROADCAST_ROWS", broadcast)
    monkeypatch.setattr(sequence, "TARGET_ROWS", target)
    rng = random.Random(1)
    # One value holds a third of the group, and one group is null.
    values = [("x", 7.0)] * 20_000 + [("x", rng.random() * 100) for _ in range(40_000)]
    values += [(None, float(v)) for v in range(21_000)]
    if whole:
        values += [("y", 3.5), ("z", 1.0), ("z", 2.0)]
    monkeypatch.setattr(quantiles, "WHOLE_GROUP", whole)
    df = spark.createDataFrame(values + [("x", None)], "g string, v double").repartition(4)
    probs = [0.0, 0.01, 0.25, 0.5, 0.99, 1.0]
    got = {r.g: r for r in exact_quantiles(df, ["v"], probs, by=["g"]).collect()}
    for g in {k for k, _ in values}:
        expected = np.quantile([v for k, v in values if k == g], probs)
        assert np.allclose([got[g][f"q{i}"] for i in range(len(probs))], expected), g
    assert got["x"].n_values == 60_000


def test_not_a_number_sorts_last_in_slices_too(spark):
    rows = [(i, "k", float("nan") if i % 10 == 0 else float(i % 50), i) for i in range(200)]
    rows += [(900, "k", None, 900), (901, "k", float("inf"), 901), (902, "k", float("-inf"), 902)]
    df = spark.createDataFrame(rows, "id bigint, key string, at double, value bigint").repartition(4)
    found = []
    for target in (10_000, 20):
        slices = plan_slices(df, "at", "id", target)
        assert slices.single == (target == 10_000)
        scanned = ordered_scan(df, ["key"], "at", "id", running={"n": F.lit(1)}, slices=slices)
        found.append(sorted((r.id, r.n) for r in scanned.collect()))
    assert found[0] == found[1]


def test_text_is_no_axis(spark):
    df = spark.createDataFrame([("k", "a"), ("k", "b")], "key string, at string")
    with pytest.raises(TypeError, match="at: string is neither a number"):
        plan_slices(df, "at", target_rows=1)
    # The window itself can order by text; only slices can't.
    assert ordered_scan(df, ["key"], "at", running={"n": F.lit(1)}, slices=sequence.Slices()).count() == 2


@pytest.mark.parametrize("target", [10_000, 2])
def test_as_of_keeps_rows_whatever_their_id(spark, target, monkeypatch):
    monkeypatch.setattr(sequence, "TARGET_ROWS", target)
    at = START + timedelta(seconds=10)
    rows = [(None, "a", at), (1.0, "a", at), (float("nan"), "a", at), (float("inf"), "a", at), (2.0, "a", None), (3.0, None, at)]
    df = spark.createDataFrame(rows, "id double, key string, at timestamp_ntz")
    offered = [("a", START, 7), ("a", at, 8), ("a", None, 9)]
    table = spark.createDataFrame(offered, "key string, known timestamp_ntz, version bigint")
    got = as_of(df, table, ["key"], "at", "known", ["version"], "id").collect()
    assert sorted((str(r.id), r.version) for r in got if r.key and r.at) == [("1.0", 7), ("None", 7), ("inf", 7), ("nan", 7)]
    assert [(r.id, r.version) for r in got if not r.key or not r.at] in ([(2.0, None), (3.0, None)], [(3.0, None), (2.0, None)])


def test_cut_points_follow_the_rows(spark):
    """One far value must not spoil the cuts, and no number limits them."""
    rows = [(i, "k", START + timedelta(microseconds=i * 3), 1) for i in range(3000)] + [(9999, "k", START + timedelta(days=9000), 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    slices = plan_slices(df, "at", "id", 10)
    assert len(slices.cuts) >= 300
    placed = sequence._with_slice(df, "at", "id", slices)
    assert placed.groupBy(sequence._SLICE).count().agg(F.max("count")).first()[0] <= 10


def test_no_task_sees_everything(spark):
    """No sketch or sort of all rows in one task: exchanges to a single partition carry counts alone."""
    from skyweave.operators import profile

    df = spark.range(1000).select(F.col("id").cast("double").alias("v"))
    plan = profile.feature_summary(df, ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


class OnACluster:
    """Just enough of a session to ask where shared files go."""

    class conf:
        @staticmethod
        def get(name, default=None):
            return default

    class sparkContext:
        master = "yarn"


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(RuntimeError):
        session.scratch_root(OnACluster())


def test_many_slices_ask_for_few_parts(spark, monkeypatch):
    asked, bucketed = [], sequence._bucketed

    def counted(df, column, cuts, out):
        asked.append(len(cuts))
        return bucketed(df, column, cuts, out)

    monkeypatch.setattr(sequence, "_bucketed", counted)
    df = spark.range(20_000).select((F.col("id") % 7).alias("k"), F.col("id").alias("at"))
    slices = plan_slices(df, "at", target_rows=4)
    assert len(slices.cuts) >= 5_000 and max(asked) <= 10 * len(slices.cuts)
    found = ordered_scan(df, ["k"], "at", previous={"was": F.col("at")}, slices=slices)
    wrong = F.when(F.col("at") < 7, F.col("was").isNotNull()).otherwise(~F.col("was").eqNullSafe(F.col("at") - 7))
    assert found.count() == 20_000 and found.where(wrong).count() == 0


def test_many_heavy_instants(spark, monkeypatch):
    monkeypatch.setattr(sequence, "_LISTED", 4)
    df = spark.range(600).select(F.lit("a").alias("k"), F.expr("CASE WHEN id < 40 THEN NULL ELSE id DIV 20 END").alias("at"), "id")
    slices = plan_slices(df, "at", "id", 8)
    assert len(slices.heavy) > 4 and len(slices.cuts) > 4 and len(slices.tie_cuts) > 4
    scanned = ordered_scan(df, ["k"], "at", "id", running={"n": F.lit(1)}, slices=slices)
    assert scanned.where(F.col("n") != F.col("id") + 1).count() == 0 and scanned.count() == 600
