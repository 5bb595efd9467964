"""Null handling, boundaries and overlaps, on hand-made rows."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from skyweave.functions.labels import flight_phase
from skyweave.functions.predicates import hint_to_column
from skyweave.functions.text import compact_number
from skyweave.operators import evaluate, features, profile, regions, rules
from skyweave.plans.medallion import time_range
from skyweave.sources import scan, sinks


def one(df):
    return df.collect()[0]


def test_phase_label_null_rules(spark):
    cases = [
        (True, 9.0, "Ground"),
        (True, None, "Ground"),
        (False, 1.5, "Cruise"),
        (False, 1.51, "Climb"),
        (False, -1.5, "Cruise"),
        (False, -1.51, "Descent"),
        (False, None, "Cruise"),
        (None, 2.0, "Climb"),
        (None, -2.0, "Descent"),
        (None, None, "Cruise"),
    ]
    df = spark.createDataFrame(cases, "on_ground boolean, vertical_rate double, expected string")
    assert df.where(flight_phase() != F.col("expected")).count() == 0


def test_region_bands_overlap_and_close(spark):
    cases = {
        -170.0: "Americas+APAC",
        -170.1: "APAC",
        -120.0: "Americas+APAC",
        -119.9: "Americas",
        -30.0: "Americas+EMEA",
        0.0: "EMEA",
        59.9: "EMEA",
        60.0: "EMEA+APAC",
        75.0: "EMEA+APAC",
        75.1: "APAC",
        180.0: "APAC",
        None: "",
    }
    df = spark.createDataFrame(list(cases.items()), "longitude double, expected string")
    found = df.select("expected", F.array_join(regions.regions_of(), "+").alias("got")).collect()
    assert all(r.expected == r.got for r in found)
    fanned = regions.route(df).count()
    assert fanned == sum(len(v.split("+")) for v in cases.values() if v)
    exclusive = {r.longitude: r.region for r in regions.route(df, "exclusive").collect()}
    assert exclusive[-30.0] == "Americas" and exclusive[60.0] == "EMEA" and exclusive[75.1] == "APAC"
    assert None not in exclusive
    with pytest.raises(ValueError):
        regions.route(df, "other")


ROW = "latitude double, longitude double, baro_altitude double, geo_altitude double, velocity double, true_track double, vertical_rate double, on_ground boolean"


def test_null_drops_but_is_no_strict_failure(spark):
    good = (10.0, 10.0, 1.0, 1.0, 1.0, 1.0, 0.0, False)
    no_latitude = (None, *good[1:])
    too_far_north = (90.1, *good[1:])
    full_circle = (*good[:5], 360.0, *good[6:])
    edges = (-90.0, 180.0, 0.0, 50000.0, 0.0, 0.0, 0.0, True)
    low_edge = (90.0, -180.0, 0.0, -500.0, 0.0, 359.9, 0.0, True)
    df = spark.createDataFrame([good, no_latitude, too_far_north, full_circle, edges, low_edge], ROW)
    report = one(rules.clean_report(df, rules.CURATED_RULES))
    assert (report.scoped_rows, report.clean_rows, report.dropped_total) == (6, 3, 3)
    assert report.fail_null_position == 1 and report.fail_latitude_range == 1
    attribution = {r.rule: r for r in rules.rule_attribution(df, rules.CURATED_RULES).collect()}
    assert attribution["latitude_range"].fail_strict == 1
    assert attribution["latitude_range"].fail_effective == 2
    kept = rules.keep_passing(df, rules.CURATED_RULES).count()
    assert kept + rules.quarantine(df, rules.CURATED_RULES).count() == 6


def test_warn_lets_null_pass(spark):
    df = spark.createDataFrame([(None, None), (60000.0, 360.0), (50000.0, 359.0)], "geo_altitude double, true_track double")
    flagged = [r.warnings for r in rules.flag_failures(df, rules.SILVER_WARN).collect()]
    assert sorted(map(len, flagged)) == [0, 0, 2]


def test_range_issues_of_nothing_is_null(spark):
    empty = spark.createDataFrame([], ROW)
    assert all(v is None for v in one(profile.out_of_range(empty, rules.RANGE_RULES)))
    assert one(rules.clean_report(empty, rules.CURATED_RULES)).scoped_rows == 0


def test_time_range_is_half_open(spark):
    stamps = [datetime(2024, 1, 1, 18, 0), datetime(2024, 1, 1, 18, 14, 59), datetime(2024, 1, 1, 18, 15)]
    df = spark.createDataFrame([(s,) for s in stamps], "time_position timestamp_ntz")
    assert df.where(time_range("2024-01-01 18:00:00", "2024-01-01 18:15:00")).count() == 2


def test_limit_comes_before_the_exact_filter(spark):
    df = spark.range(100).select("id", (F.col("id") % 2).cast("double").alias("baro_altitude"))
    hint = {
        "op": "lessThan",
        "children": [
            {"op": "column", "name": "baro_altitude", "valueType": "double"},
            {"op": "literal", "value": "1", "valueType": "double"},
        ],
    }
    assert scan.hinted_read(df, hint, 10, ["id"]).count() == 5
    assert scan.hinted_scan(df, hint).count() == 50
    with pytest.raises(ValueError):
        hint_to_column({"op": "between", "children": []})


def test_unknown_key_gives_null_features(spark):
    rows = spark.createDataFrame([(i, "hot") for i in range(500)] + [(500, "new"), (501, None)], "id bigint, k string")
    table = spark.createDataFrame([("hot", 1.0), ("cold", 2.0)], "k string, f double")
    for row_id in (None, "id"):
        found = features.lookup(rows, table, "k", ["f"], row_id=row_id, hot_share=0.1, pieces=4).collect()
        assert len(found) == 502
        assert {r.id: r.f for r in found} == {**{i: 1.0 for i in range(500)}, 500: None, 501: None}


def test_report_with_a_label_never_predicted(spark):
    rows = [("a", "a")] * 3 + [("b", "a")] + [("a", "c")]
    df = spark.createDataFrame(rows, "y string, p string")
    report = {r.label: r for r in evaluate.classification_report(df, "y", "p").collect()}
    assert "c" not in report
    assert (report["b"].precision, report["b"].recall, report["b"].f1, report["b"].support) == (0, 0, 0, 1)
    assert report["a"].precision == 0.75 and report["a"].recall == 0.75
    # The union of labels has three members, one of them only predicted.
    assert abs(one(evaluate.macro_f1(df, "y", "p")).macro_f1 - 0.25) < 1e-9


def test_class_weights_are_balanced(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)], "y string")
    weights = {r.y: r.class_weight for r in evaluate.class_weights(df, "y").collect()}
    assert weights == {"a": 4 / (2 * 3), "b": 4 / (2 * 1)}


def test_compact_numbers(spark):
    cases = [(7.0, "7.0"), (999.0, "999.0"), (1000.0, "1.0K"), (1_250_000.0, "1.3M"), (2.5e9, "2.5B"), (None, None)]
    df = spark.createDataFrame(cases, "v double, expected string")
    assert df.where(~compact_number(F.col("v")).eqNullSafe(F.col("expected"))).count() == 0


def test_primary_key_is_enforced(spark, tmp_path):
    repeated = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int")
    with pytest.raises(ValueError):
        sinks.keyed_table(repeated, str(tmp_path / "t"), ["k"])
    with pytest.raises(ValueError):
        sinks.check_key(spark.createDataFrame([(None, 1)], "k string, v int"), ["k"])


def test_replace_range_touches_only_its_days(spark, tmp_path):
    path = str(tmp_path / "days")
    rows = spark.createDataFrame([(1, date(2024, 1, 1)), (2, date(2024, 1, 2)), (3, date(2024, 1, 3))], "v int, day date")
    sinks.overwrite(rows, path, ["day"])
    fresh = rows.withColumn("v", F.col("v") * 10)
    after = sinks.replace_range(fresh, path, "day", date(2024, 1, 2), date(2024, 1, 3))
    assert sorted(r.v for r in after.collect()) == [1, 3, 20]


def test_fill_of_both_histograms_agrees(spark):
    df = spark.createDataFrame([(float(v),) for v in (-5, 0, 999, 1000, 2500)] + [(None,)], "v double")
    bins = {r.bin_start: r.n_rows for r in profile.histogram(df, "v", 1000).collect()}
    assert bins == {-1000.0: 1, 0.0: 2, 1000.0: 1, 2000.0: 1}


def test_compact_numbers_once_more(spark):
    from skyweave.functions.text import compact_number

    expected = {
        0: "0.0", 999: "999.0", 1000: "1.0K", 999_949: "999.9K", 999_950: "1.0M", 1_234_567: "1.2M",
        999_949_999: "999.9M", 999_950_000: "1.0B", 999_999_999: "1.0B", -999_950: "-1.0M", 2.5e12: "2500.0B",
    }
    df = spark.createDataFrame([(float(v),) for v in expected] + [(None,)], "v double")
    got = {r.v: r.text for r in df.select("v", compact_number(F.col("v")).alias("text")).collect()}
    assert got == {**{float(k): v for k, v in expected.items()}, None: None}


def test_log_ids_tell_keys_apart(spark):
    from skyweave.session import scratch_path
    from skyweave.sources import sinks

    keys = [("a", None), (None, "a"), ("a|", "b"), ("a", "|b")]
    df = spark.createDataFrame(keys, "x string, y string")
    path = scratch_path(spark, "test-log")
    assert sinks.append_log(df, path, ["x", "y"]).select("id").distinct().count() == 4
    assert sinks.append_log(df, path, ["x", "y"]).count() == 4
    more = spark.createDataFrame([("a", None), ("new", None)], "x string, y string")
    assert sinks.append_log(more, path, ["x", "y"]).count() == 5


def test_a_failed_overwrite_leaves_the_table(spark):
    from skyweave.session import scratch_path
    from skyweave.sources import sinks

    path = scratch_path(spark, "test-table")
    sinks.overwrite(spark.range(5).toDF("a"), path)
    broken = spark.range(5).select(F.raise_error(F.lit("no")).alias("a"))
    with pytest.raises(Exception, match="no"):
        sinks.overwrite(broken, path)
    assert sinks.overwrite(spark.read.parquet(path).withColumn("b", F.lit(1)), path).columns == ["a", "b"]
    assert spark.read.parquet(path).count() == 5


def test_replace_range_empties_days(spark):
    from datetime import date

    from skyweave.session import scratch_path
    from skyweave.sources import sinks

    path = scratch_path(spark, "test-days")
    days = [(i, date(2024, 1, 1 + i)) for i in range(5)]
    sinks.overwrite(spark.createDataFrame(days, "v int, day date"), path, ["day"])
    fresh = spark.createDataFrame([(20, date(2024, 1, 2)), (90, date(2024, 1, 9))], "v int, day date")
    found = sinks.replace_range(fresh, path, "day", date(2024, 1, 2), date(2024, 1, 4))
    assert sorted((r.v, r.day.day) for r in found.collect()) == [(0, 1), (3, 4), (4, 5), (20, 2)]
    nothing = sinks.replace_range(fresh.limit(0), path, "day", date(2024, 1, 1), date(2024, 1, 3))
    assert sorted(r.v for r in nothing.collect()) == [3, 4]
