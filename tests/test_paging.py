"""Pages cut at counted keys, logs by day, percentiles at many steps."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyweave.operators.quantiles import step_values
from skyweave.session import scratch_path
from skyweave.sources import scan, sinks


def test_pages_hold_all_rows_once(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1009).alias("k"))
    pages = scan.ranged_pages(df, "k", 300)
    found = [sorted(r.k for r in p.collect()) for p in pages]
    assert [len(p) for p in found] == [300, 300, 300, 100]
    assert sum(found, []) == sorted(i * 7 % 1009 for i in range(1000))
    assert scan.ranged_pages(df.limit(0), "k", 300) == []


def test_log_by_day(spark):
    path = scratch_path(spark, "day-log")
    rows = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02"), (3, None)], "k long, d string")
    first = rows.withColumn("day", F.col("d").cast("date")).drop("d")
    more = spark.createDataFrame([(2, "2024-01-02"), (3, None), (4, "2024-01-02")], "k long, d string")
    second = more.withColumn("day", F.col("d").cast("date")).drop("d")
    sinks.append_log(first, path, ["k", "day"], day="day")
    sinks.append_log(second, path, ["k", "day"], day="day")
    found = sinks.append_log(second, path, ["k", "day"], day="day")
    assert sorted((r.k, str(r.day)) for r in found.collect()) == [(1, "2024-01-01"), (2, "2024-01-02"), (3, "None"), (4, "2024-01-02")]


@pytest.mark.parametrize("target", [None, 20])
def test_step_values(spark, target):
    rng = np.random.default_rng(1)
    a, b = np.round(rng.normal(size=300), 1), rng.normal(size=300)
    rows = [(float(x), float(y)) for x, y in zip(a, b)] + [(None, float("nan"))]
    df = spark.createDataFrame(rows, "a double, b double")
    found = {(r.feature, r.step): r.value for r in step_values(df, ["a", "b"], 7, target).collect()}
    assert len(found) == 12
    for (name, step), value in found.items():
        assert value == pytest.approx(np.quantile(a if name == "a" else b, step / 7), abs=1e-12)
    assert {r.value for r in step_values(spark.createDataFrame([(2.0,)], "a double"), ["a"], 4).collect()} == {2.0}
