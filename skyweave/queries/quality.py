"""Rules, expectations and anomaly counts."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from skyweave.operators import rules
from skyweave.operators.profile import CHECK_COLUMNS, missing_profile, null_counts, out_of_range
from skyweave.plans.medallion import time_range
from skyweave.queries.base import SILVER, SILVER_KEEP, SV, query
from skyweave.session import scratch_path
from skyweave.sources.sinks import overwrite
from skyweave.sources.telemetry import state_vectors

# Rule names and limits, the same rules again as text for the oracles.
_CURATED_SQL = {
    "null_position": "latitude IS NOT NULL AND longitude IS NOT NULL",
    "latitude_range": "latitude BETWEEN -90 AND 90",
    "longitude_range": "longitude BETWEEN -180 AND 180",
    "geo_altitude_range": "geo_altitude BETWEEN -500 AND 50000",
    "true_track_range": "true_track >= 0 AND true_track < 360",
    "features_not_null": "baro_altitude IS NOT NULL AND geo_altitude IS NOT NULL AND velocity IS NOT NULL AND true_track IS NOT NULL",
    "label_cols_not_null": "vertical_rate IS NOT NULL AND on_ground IS NOT NULL",
}
_WARN_SQL = {
    "reasonable_geo_altitude": "geo_altitude IS NULL OR (geo_altitude >= -500 AND geo_altitude <= 50000)",
    "valid_track": "true_track IS NULL OR (true_track >= 0 AND true_track < 360)",
}
_DROP_SQL = {
    "valid_position": "latitude IS NOT NULL AND longitude IS NOT NULL",
    "valid_latitude_range": "latitude BETWEEN -90 AND 90",
    "valid_longitude_range": "longitude BETWEEN -180 AND 180",
    "plausible_velocity": "velocity IS NULL OR velocity BETWEEN 0 AND 350",
    "plausible_baro_altitude": "baro_altitude IS NULL OR baro_altitude BETWEEN -500 AND 20000",
}
_BROKEN = {
    "icao24_malformed": ("identifier", "NOT regexp_matches(icao24, '^[0-9a-fA-F]{6}$')"),
    "callsign_missing": ("identifier", "callsign IS NULL"),
    "callsign_malformed": ("identifier", "NOT regexp_matches(callsign, '^[A-Z0-9]{2,8} *$')"),
    "latitude_out_of_range": ("coordinates", "latitude NOT BETWEEN -90 AND 90"),
    "longitude_out_of_range": ("coordinates", "longitude NOT BETWEEN -180 AND 180"),
    "position_at_origin": ("coordinates", "latitude = 0 AND longitude = 0"),
    "baro_altitude_extreme": ("altitude", "baro_altitude NOT BETWEEN -500 AND 20000"),
    "velocity_extreme": ("velocity", "velocity NOT BETWEEN 0 AND 350"),
    "true_track_out_of_range": ("heading", "true_track < 0 OR true_track >= 360"),
}
_BROKEN_MORE = {
    "vertical_rate_extreme": ("kinematics", "abs(vertical_rate) > 50"),
    "baro_geo_gap": ("altitude", "abs(baro_altitude - geo_altitude) > 1000"),
    "baro_altitude_negative": ("altitude", "baro_altitude < 0"),
    "contact_after_position": ("timestamps", "last_contact > time_position"),
    "update_after_position": ("timestamps", "last_pos_update > time_position"),
}


def _anomaly_sql(broken: dict) -> str:
    return " UNION ALL ".join(
        f"SELECT '{category}' AS category, '{name}' AS rule, count(*) FILTER (WHERE {text}) AS n, "
        f"round(100.0 * count(*) FILTER (WHERE {text}) / count(*), 4) AS pct FROM sv"
        for name, (category, text) in broken.items()
    )


@query(
    "null_counts",
    SV + " UNION ALL ".join(
        f" SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM sv" for c in CHECK_COLUMNS
    ),
)
def null_counts_query(spark, folder):
    return null_counts(state_vectors(spark, folder), CHECK_COLUMNS)


@query(
    "missing_profile",
    SV + " UNION ALL ".join(
        f" SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_null, "
        f"round(100.0 * count(*) FILTER (WHERE {c} IS NULL) / count(*), 2) AS pct_null FROM sv"
        for c in ["callsign", "squawk", *CHECK_COLUMNS]
    ),
)
def missing_profile_query(spark, folder):
    return missing_profile(state_vectors(spark, folder), ["callsign", "squawk", *CHECK_COLUMNS])


@query(
    "range_issues",
    f"""{SV} SELECT
    CAST(sum(CAST(NOT (latitude BETWEEN -90 AND 90) AS INT)) AS BIGINT) AS latitude_out_of_range,
    CAST(sum(CAST(NOT (longitude BETWEEN -180 AND 180) AS INT)) AS BIGINT) AS longitude_out_of_range,
    CAST(sum(CAST(geo_altitude IS NOT NULL AND NOT (geo_altitude BETWEEN -500 AND 50000) AS INT)) AS BIGINT)
    AS geo_altitude_out_of_range,
    CAST(sum(CAST(true_track < 0 OR true_track >= 360 AS INT)) AS BIGINT) AS true_track_out_of_range FROM sv""",
)
def range_issues_query(spark, folder):
    return out_of_range(state_vectors(spark, folder), rules.RANGE_RULES)


@query(
    "rule_attribution",
    SV + " UNION ALL ".join(
        f" SELECT '{name}' AS rule, count(*) FILTER (WHERE NOT ({text})) AS fail_strict, "
        f"count(*) FILTER (WHERE NOT coalesce({text}, false)) AS fail_effective FROM sv"
        for name, text in _CURATED_SQL.items()
    ),
)
def rule_attribution(spark, folder):
    return rules.rule_attribution(state_vectors(spark, folder), rules.CURATED_RULES)


_ALL = " AND ".join(f"({text})" for text in _CURATED_SQL.values())


@query(
    "clean_report",
    f"""{SV} SELECT count(*) AS scoped_rows, count(*) FILTER (WHERE {_ALL}) AS clean_rows,
    count(*) - count(*) FILTER (WHERE {_ALL}) AS dropped_total, """
    + ", ".join(f"count(*) FILTER (WHERE NOT ({t})) AS fail_{n}" for n, t in _CURATED_SQL.items())
    + " FROM sv",
)
def clean_report(spark, folder):
    return rules.clean_report(state_vectors(spark, folder), rules.CURATED_RULES)


@query(
    "clean_report_scoped",
    f"""{SV} SELECT count(*) AS scoped_rows, count(*) FILTER (WHERE {_ALL}) AS clean_rows,
    count(*) - count(*) FILTER (WHERE {_ALL}) AS dropped_total, """
    + ", ".join(f"count(*) FILTER (WHERE NOT ({t})) AS fail_{n}" for n, t in _CURATED_SQL.items())
    + """ FROM sv WHERE longitude BETWEEN -170 AND -30 AND time_position >= TIMESTAMP '2024-01-05'
    AND time_position < TIMESTAMP '2024-01-25'""",
)
def clean_report_scoped(spark, folder):
    from skyweave.operators.regions import in_region

    scoped = state_vectors(spark, folder).where(
        in_region("Americas") & time_range("2024-01-05 00:00:00", "2024-01-25 00:00:00")
    )
    return rules.clean_report(scoped, rules.CURATED_RULES)


@query("anomaly_counts", f"{SV} {_anomaly_sql(_BROKEN)}")
def anomaly_counts(spark, folder):
    return rules.anomaly_counts(state_vectors(spark, folder))


@query("anomaly_extended", f"{SV} {_anomaly_sql(_BROKEN_MORE)}")
def anomaly_extended(spark, folder):
    return rules.anomaly_counts(state_vectors(spark, folder), rules.EXTENDED_RULES)


@query(
    "check_rollup",
    f"""{SV}, a AS ({_anomaly_sql(_BROKEN | _BROKEN_MORE)})
    SELECT category, rule, count(*) AS checks, CAST(sum(n) AS BIGINT) AS anomalies,
    count(*) FILTER (WHERE n > 0) AS checks_with_anomalies, CAST(grouping(category, rule) AS INTEGER) AS level
    FROM a GROUP BY ROLLUP (category, rule)""",
)
def check_rollup(spark, folder):
    counts = rules.anomaly_counts(state_vectors(spark, folder), rules.ANOMALY_RULES + rules.EXTENDED_RULES)
    return rules.check_rollup(counts)


_EXPECT = _DROP_SQL | _WARN_SQL


@query(
    "expectation_metrics",
    SV + " UNION ALL ".join(
        f" SELECT '{name}' AS rule, count(*) FILTER (WHERE {text}) AS passed, "
        f"count(*) - count(*) FILTER (WHERE {text}) AS failed FROM sv"
        for name, text in _EXPECT.items()
    ),
)
def expectation_metrics(spark, folder):
    return rules.expectation_metrics(state_vectors(spark, folder), rules.SILVER_DROP + rules.SILVER_WARN)


def expectation_sql(source: str) -> str:
    """Passed and failed rows of every silver expectation."""
    return SV + " UNION ALL ".join(
        f" SELECT '{name}' AS rule, count(*) FILTER (WHERE {text}) AS passed, "
        f"count(*) - count(*) FILTER (WHERE {text}) AS failed FROM {source}"
        for name, text in _EXPECT.items()
    )


@query(
    "expectation_observed",
    SV + " UNION ALL ".join(
        f" SELECT '{name}' AS rule, count(*) FILTER (WHERE {text}) AS passed FROM sv"
        for name, text in _EXPECT.items()
    ),
)
def expectation_observed(spark, folder):
    # The counters come from the job that writes the silver table, not from a job of their own.
    every = rules.SILVER_DROP + rules.SILVER_WARN
    seen = Observation("silver")
    watched = rules.observe_expectations(state_vectors(spark, folder), seen, every)
    overwrite(rules.keep_passing(watched, rules.SILVER_DROP), scratch_path(spark, "observed"))
    counted = seen.get
    return spark.createDataFrame([(r.name, counted[r.name]) for r in every], "rule string, passed bigint")


@query("expect_drop", f"{SILVER} SELECT event_id, icao24, latitude, longitude, velocity, baro_altitude FROM silver")
def expect_drop(spark, folder):
    return rules.keep_passing(state_vectors(spark, folder), rules.SILVER_DROP).select(
        "event_id", "icao24", "latitude", "longitude", "velocity", "baro_altitude"
    )


def _failed_sql(texts: dict) -> str:
    cases = ", ".join(f"CASE WHEN NOT coalesce({t}, false) THEN '{n}' END" for n, t in texts.items())
    return f"concat_ws(',', {cases})"


@query("expect_warn", f"{SV} SELECT event_id, {_failed_sql(_WARN_SQL)} AS warnings FROM sv")
def expect_warn(spark, folder):
    flagged = rules.flag_failures(state_vectors(spark, folder), rules.SILVER_WARN)
    return flagged.select("event_id", F.concat_ws(",", "warnings").alias("warnings"))


@query(
    "quarantine",
    f"""{SV} SELECT event_id, {_failed_sql(_DROP_SQL)} AS reasons FROM sv
    WHERE NOT coalesce({SILVER_KEEP}, false)""",
)
def quarantine(spark, folder):
    held = rules.quarantine(state_vectors(spark, folder), rules.SILVER_DROP)
    return held.select("event_id", F.concat_ws(",", "reasons").alias("reasons"))
