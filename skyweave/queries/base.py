"""Registry and the SQL texts shared by the oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from skyweave.functions.labels import flight_phase
from skyweave.operators.rules import CURATED_RULES, keep_passing
from skyweave.sources.telemetry import MAPPING, state_vectors

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can express it, the text to compare with."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    """All state vectors with their phase."""
    return state_vectors(spark, folder).withColumn("flight_phase", flight_phase())


def curated(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that pass every curated rule, with their phase."""
    return keep_passing(labelled(spark, folder), CURATED_RULES)


_OTHER_DIALECT = {"last_pos_update": "date_trunc('day', ts)"}
_COLUMNS = ", ".join(f"{_OTHER_DIALECT.get(name, text)} AS {name}" for name, text in MAPPING.items())

PHASE = (
    "CASE WHEN on_ground THEN 'Ground' WHEN vertical_rate > 1.5 THEN 'Climb' "
    "WHEN vertical_rate < -1.5 THEN 'Descent' ELSE 'Cruise' END"
)
KEEP = (
    "latitude IS NOT NULL AND longitude IS NOT NULL AND latitude BETWEEN -90 AND 90 "
    "AND longitude BETWEEN -180 AND 180 AND geo_altitude BETWEEN -500 AND 50000 "
    "AND true_track >= 0 AND true_track < 360 AND baro_altitude IS NOT NULL AND geo_altitude IS NOT NULL "
    "AND velocity IS NOT NULL AND true_track IS NOT NULL AND vertical_rate IS NOT NULL AND on_ground IS NOT NULL"
)
SILVER_KEEP = (
    "latitude IS NOT NULL AND longitude IS NOT NULL AND latitude BETWEEN -90 AND 90 "
    "AND longitude BETWEEN -180 AND 180 AND (velocity IS NULL OR velocity BETWEEN 0 AND 350) "
    "AND (baro_altitude IS NULL OR baro_altitude BETWEEN -500 AND 20000)"
)
RULE_CLASS = (
    "CASE WHEN baro_altitude < 300 THEN 'Ground' WHEN baro_altitude >= 8000 THEN 'Cruise' "
    "WHEN baro_altitude IS NULL THEN 'Cruise' ELSE 'Climb' END"
)

# Common table expressions the oracle texts start from.
SV = f"WITH sv AS (SELECT {_COLUMNS} FROM events)"
LABELLED = f"{SV}, lab AS (SELECT *, {PHASE} AS flight_phase FROM sv)"
CURATED = f"{LABELLED}, cur AS (SELECT * FROM lab WHERE {KEEP})"
SILVER = f"{SV}, silver AS (SELECT * FROM sv WHERE {SILVER_KEEP})"
JUDGED = f"{CURATED}, judged AS (SELECT *, {RULE_CLASS} AS flight_phase_pred FROM cur)"

# The region bands.
BAND = {
    "Americas": "(longitude BETWEEN -170 AND -30)",
    "EMEA": "(longitude BETWEEN -30 AND 75)",
    "APAC": "(longitude >= 60 OR longitude <= -120)",
}


def band_union(source: str, columns: str) -> str:
    """One branch per region, duplicates kept."""
    return " UNION ALL ".join(
        f"SELECT {columns}, '{region}' AS region FROM {source} WHERE {text}" for region, text in BAND.items()
    )
