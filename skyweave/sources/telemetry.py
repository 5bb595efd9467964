"""The state-vector view the operators run on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY = "icao24"
TIME = "time_position"
ROW_ID = "event_id"

# Schema of one state vector.
STATE_VECTOR_SCHEMA = T.StructType(
    [
        T.StructField("icao24", T.StringType()),
        T.StructField("callsign", T.StringType()),
        T.StructField("time_position", T.TimestampType()),
        T.StructField("last_contact", T.TimestampType()),
        T.StructField("last_pos_update", T.TimestampType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("baro_altitude", T.DoubleType()),
        T.StructField("geo_altitude", T.DoubleType()),
        T.StructField("velocity", T.DoubleType()),
        T.StructField("true_track", T.DoubleType()),
        T.StructField("vertical_rate", T.DoubleType()),
        T.StructField("on_ground", T.BooleanType()),
        T.StructField("alert", T.BooleanType()),
        T.StructField("spi", T.BooleanType()),
        T.StructField("squawk", T.StringType()),
        T.StructField("sensors", T.ArrayType(T.LongType())),
    ]
)

# The mapping from the events table to state vectors (FIXTURES.md, section 3).
_GROUND = "(event_type = 'signup')"
_RATE = f"(CASE WHEN {_GROUND} THEN 0.0E0 ELSE CAST((event_id*613)%2001 AS DOUBLE)/100.0E0-10.0E0 END)"
_ALT = "((event_id*3571)%9973)"
MAPPING = {
    "event_id": "event_id",
    "icao24": "lpad(CAST(user_id AS VARCHAR(20)),6,'0')",
    "callsign": "CASE WHEN event_id%53=0 THEN NULL WHEN event_id%59=0 THEN '#BAD' "
    "ELSE concat('TST',CAST(user_id AS VARCHAR(20)),' ') END",
    "time_position": "ts",
    "latitude": "CASE WHEN event_id%97=0 THEN NULL ELSE CAST((event_id*7919)%18100 AS DOUBLE)/100.0E0-90.5E0 END",
    "longitude": "CASE WHEN event_id%97=0 THEN NULL ELSE CAST((event_id*104729)%36200 AS DOUBLE)/100.0E0-181.0E0 END",
    "baro_altitude": f"CASE WHEN event_id%89=0 THEN NULL WHEN {_GROUND} THEN CAST({_ALT}%300 AS DOUBLE) "
    f"WHEN {_RATE} BETWEEN -1.5E0 AND 1.5E0 THEN 8000.0E0+CAST({_ALT}%5000 AS DOUBLE) "
    f"ELSE CAST({_ALT}%9300 AS DOUBLE)-300.0E0 END",
    "geo_altitude": f"CASE WHEN event_id%79=0 THEN NULL WHEN event_id%211=0 THEN 60000.0E0 "
    f"WHEN {_GROUND} THEN CAST({_ALT}%300 AS DOUBLE) ELSE CAST({_ALT} AS DOUBLE)+180.0E0 END",
    "velocity": "CASE WHEN event_id%83=0 THEN NULL ELSE value END",
    "true_track": "CAST((event_id*37)%3650 AS DOUBLE)/10.0E0",
    "vertical_rate": f"CASE WHEN event_id%71=0 THEN NULL ELSE {_RATE} END",
    "on_ground": _GROUND,
    "last_contact": "ts - INTERVAL '5' SECOND",
    "last_pos_update": "CAST(date_trunc('DAY', ts) AS TIMESTAMP_NTZ)",
    "alert": "event_id%101=0",
    "spi": "event_id%103=0",
    "squawk": "lpad(CAST((event_id*31)%7778 AS VARCHAR(20)),4,'0')",
    "sensors": "CASE event_id%4 WHEN 0 THEN '[]' WHEN 1 THEN '[-1408129013]' "
    "WHEN 2 THEN '[-1408129013,1408045066]' ELSE '[-1408129013,1408045066,62407238]' END",
}


def to_state_vectors(events: DataFrame) -> DataFrame:
    """Map an events-shaped DataFrame, batch or streaming, to state vectors (sensors stay JSON text)."""
    return events.selectExpr(*[f"{text} AS {name}" for name, text in MAPPING.items()])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def events_path(folder: str) -> str:
    """Stream path of the events table. A pattern, so it fits a single file as well as a folder."""
    return f"{folder}/events.parquet*"


def state_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """State vectors over the whole events table."""
    return to_state_vectors(table(spark, folder, "events"))


def parse_sensors(df: DataFrame, column: str = "sensors") -> DataFrame:
    """Replace the JSON text by an array of sensor ids."""
    return df.withColumn(column, F.from_json(column, "array<bigint>"))
