"""Named data-quality rules: cleaning, warnings, quarantine and one-pass accounting.

A rule is a name and a SQL predicate, so the same set serves SQL constraints and DataFrames. SQL has
three truth values and the two ways of counting failures differ on the third one:

* strict - rows where NOT rule is true; a null outcome is no failure
* effective - rows the rule keeps out of a cleaned table; a null outcome is a failure
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    name: str
    predicate: str
    category: str = "general"

    def holds(self) -> Column:
        return F.expr(self.predicate)

    def passes(self) -> Column:
        return F.coalesce(self.holds(), F.lit(False))


def within(column: str, low, high, *, open_end: bool = False, null_passes: bool = False) -> str:
    """Predicate text for a range check."""
    text = f"{column} >= {low} AND {column} {'<' if open_end else '<='} {high}"
    return f"{column} IS NULL OR ({text})" if null_passes else text


def present(*columns: str) -> str:
    """Predicate text: every column is non-null."""
    return " AND ".join(f"{c} IS NOT NULL" for c in columns)


# The limits of the curated table. All are hard rules and null fails.
CURATED_RULES = (
    Rule("null_position", present("latitude", "longitude"), "completeness"),
    Rule("latitude_range", within("latitude", -90, 90), "coordinates"),
    Rule("longitude_range", within("longitude", -180, 180), "coordinates"),
    Rule("geo_altitude_range", within("geo_altitude", -500, 50000), "altitude"),
    Rule("true_track_range", within("true_track", 0, 360, open_end=True), "heading"),
    Rule(
        "features_not_null",
        present("baro_altitude", "geo_altitude", "velocity", "true_track"),
        "completeness",
    ),
    Rule("label_cols_not_null", present("vertical_rate", "on_ground"), "completeness"),
)

# The range limits alone, named after their columns.
RANGE_RULES = tuple(
    Rule(rule.name.removesuffix("_range"), rule.predicate, rule.category)
    for rule in CURATED_RULES
    if rule.name.endswith("_range")
)

# Silver table. Position rules drop; altitude and heading only warn and let null pass.
# The speed and altitude limits of the drop set are our own choice.
SILVER_DROP = (
    Rule("valid_position", present("latitude", "longitude"), "completeness"),
    Rule("valid_latitude_range", within("latitude", -90, 90), "coordinates"),
    Rule("valid_longitude_range", within("longitude", -180, 180), "coordinates"),
    Rule("plausible_velocity", within("velocity", 0, 350, null_passes=True), "velocity"),
    Rule("plausible_baro_altitude", within("baro_altitude", -500, 20000, null_passes=True), "altitude"),
)
SILVER_WARN = (
    Rule("reasonable_geo_altitude", within("geo_altitude", -500, 50000, null_passes=True), "altitude"),
    Rule("valid_track", within("true_track", 0, 360, open_end=True, null_passes=True), "heading"),
)

# Our own thresholds for the anomaly report; a rule here states what is normal.
ANOMALY_RULES = (
    Rule("icao24_malformed", "icao24 RLIKE '^[0-9a-fA-F]{6}$'", "identifier"),
    Rule("callsign_missing", "callsign IS NOT NULL", "identifier"),
    Rule("callsign_malformed", "callsign RLIKE '^[A-Z0-9]{2,8} *$'", "identifier"),
    Rule("latitude_out_of_range", "latitude BETWEEN -90 AND 90", "coordinates"),
    Rule("longitude_out_of_range", "longitude BETWEEN -180 AND 180", "coordinates"),
    Rule("position_at_origin", "NOT (latitude = 0 AND longitude = 0)", "coordinates"),
    Rule("baro_altitude_extreme", "baro_altitude BETWEEN -500 AND 20000", "altitude"),
    Rule("velocity_extreme", "velocity BETWEEN 0 AND 350", "velocity"),
    Rule("true_track_out_of_range", "true_track >= 0 AND true_track < 360", "heading"),
)
EXTENDED_RULES = (
    Rule("vertical_rate_extreme", "abs(vertical_rate) <= 50", "kinematics"),
    Rule("baro_geo_gap", "abs(baro_altitude - geo_altitude) <= 1000", "altitude"),
    Rule("baro_altitude_negative", "baro_altitude >= 0", "altitude"),
    Rule("contact_after_position", "last_contact <= time_position", "timestamps"),
    Rule("update_after_position", "last_pos_update <= time_position", "timestamps"),
)


def all_hold(rules) -> Column:
    """True only where every rule is true."""
    return reduce(lambda a, b: a & b, [rule.passes() for rule in rules])


def keep_passing(df: DataFrame, rules) -> DataFrame:
    """Drop every row that any rule does not affirm."""
    return df.where(reduce(lambda a, b: a & b, [rule.holds() for rule in rules]))


def failed_names(rules) -> Column:
    """Names of the rules a row fails, in rule order."""
    return F.array_compact(F.array(*[F.when(~rule.passes(), F.lit(rule.name)) for rule in rules]))


def flag_failures(df: DataFrame, rules, column: str = "warnings") -> DataFrame:
    """Keep every row and note which rules it fails."""
    return df.withColumn(column, failed_names(rules))


def quarantine(df: DataFrame, rules, column: str = "reasons") -> DataFrame:
    """Only the rows that fail, with their reasons; the complement of ``keep_passing``."""
    return flag_failures(df, rules, column).where(F.size(column) > 0)


def clean_report(df: DataFrame, rules) -> DataFrame:
    """One row: rows in scope, kept and dropped, and the strict failure count of each rule.

    A single aggregate pass, however many rules there are.
    """
    kept = F.count_if(all_hold(rules))
    total = F.count(F.lit(1))
    return df.agg(
        total.alias("scoped_rows"),
        kept.alias("clean_rows"),
        (total - kept).alias("dropped_total"),
        *[F.count_if(~rule.holds()).alias(f"fail_{rule.name}") for rule in rules],
    )


def _long(row: DataFrame, rules, fields: dict[str, str]) -> DataFrame:
    """Turn the one-row aggregate into one row per rule."""
    entries = [
        F.struct(
            F.lit(rule.category).alias("category"),
            F.lit(rule.name).alias("rule"),
            *[F.col(f"{prefix}{i}").alias(out) for out, prefix in fields.items()],
        )
        for i, rule in enumerate(rules)
    ]
    return row.select("total", F.inline(F.array(*entries)))


def rule_attribution(df: DataFrame, rules) -> DataFrame:
    """Failures per rule under both readings of a null outcome."""
    row = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(~rule.holds()).alias(f"s{i}") for i, rule in enumerate(rules)],
        *[F.count_if(~rule.passes()).alias(f"e{i}") for i, rule in enumerate(rules)],
    )
    return _long(row, rules, {"fail_strict": "s", "fail_effective": "e"}).drop("category", "total")


def expectation_metrics(df: DataFrame, rules) -> DataFrame:
    """Rows passed and failed per expectation."""
    row = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(rule.passes()).alias(f"p{i}") for i, rule in enumerate(rules)],
    )
    long = _long(row, rules, {"passed": "p"})
    return long.select("rule", "passed", (F.col("total") - F.col("passed")).alias("failed"))


def anomaly_counts(df: DataFrame, rules=ANOMALY_RULES, digits: int = 4) -> DataFrame:
    """Rows that break each rule, with their share in percent; null outcomes are not anomalies."""
    row = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(~rule.holds()).alias(f"n{i}") for i, rule in enumerate(rules)],
    )
    return _long(row, rules, {"n": "n"}).select(
        "category", "rule", "n", F.round(100.0 * F.col("n") / F.col("total"), digits).alias("pct")
    )


def check_rollup(counts: DataFrame) -> DataFrame:
    """Checks and anomalies per rule, per category and overall (``level`` 0, 1 and 3)."""
    return counts.rollup("category", "rule").agg(
        F.count(F.lit(1)).alias("checks"),
        F.sum("n").alias("anomalies"),
        F.count_if(F.col("n") > 0).alias("checks_with_anomalies"),
        F.grouping_id().cast("int").alias("level"),
    )


def observe_expectations(df: DataFrame, observation, rules) -> DataFrame:
    """Attach pass counters to a DataFrame; they fill in as a by-product of whatever job runs it."""
    return df.observe(
        observation,
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(rule.passes()).alias(rule.name) for rule in rules],
    )
