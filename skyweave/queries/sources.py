"""Scans, sinks, projections and filters."""

from __future__ import annotations

import json
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyweave.functions.labels import flight_phase
from skyweave.functions.text import address_status, callsign_status, clock, compact_number, grouped_number
from skyweave.operators.features import ROW_FEATURES, entity_features, without_nulls
from skyweave.operators.metrics import cross_filter
from skyweave.operators.profile import describe, kpi_tiles, sensor_stats
from skyweave.operators.rules import CURATED_RULES, keep_passing
from skyweave.plans.medallion import time_of_day, time_range
from skyweave.queries.base import CURATED, LABELLED, PHASE, RULE_CLASS, SV, curated, labelled, query
from skyweave.session import scratch_path
from skyweave.sources import scan, sinks
from skyweave.sources.telemetry import MAPPING, STATE_VECTOR_SCHEMA, parse_sensors, state_vectors, table

# Columns of the curated table.
CURATED_COLUMNS = [
    "icao24",
    "callsign",
    "time_position",
    "latitude",
    "longitude",
    "baro_altitude",
    "geo_altitude",
    "velocity",
    "true_track",
    "vertical_rate",
    "on_ground",
]
_CURATED_LIST = ", ".join(CURATED_COLUMNS)


@query("scan_table", "SELECT * FROM lineitem")
def scan_table(spark, folder):
    return table(spark, folder, "lineitem")


@query("preview", f"{SV} SELECT event_id, icao24, time_position, velocity FROM sv ORDER BY time_position, event_id LIMIT 10")
def preview(spark, folder):
    df = state_vectors(spark, folder).select("event_id", "icao24", "time_position", "velocity")
    return scan.preview(df, ["time_position", "event_id"])


_KINDS = {
    "bigint": ["event_id"],
    "string": ["icao24", "callsign", "squawk", "sensors"],
    "timestamp_ntz": ["time_position", "last_contact", "last_pos_update"],
    "double": ["latitude", "longitude", "baro_altitude", "geo_altitude", "velocity", "true_track", "vertical_rate"],
    "boolean": ["on_ground", "alert", "spi"],
}
_KIND_OF = {name: kind for kind, names in _KINDS.items() for name in names}


@query(
    "describe_schema",
    SV
    + " UNION ALL ".join(
        f" SELECT CAST({i} AS INTEGER) AS position, '{c}' AS column_name, '{_KIND_OF[c]}' AS data_type, "
        f"count({c}) AS n_values FROM sv"
        for i, c in enumerate(MAPPING, start=1)
    ),
)
def describe_schema(spark, folder):
    return describe(state_vectors(spark, folder))


def _as_file(df):
    """State vectors in the column order and text form of a CSV delivery."""
    stamps = {c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'") for c in ("time_position", "last_contact", "last_pos_update")}
    return df.withColumns(stamps).select(*STATE_VECTOR_SCHEMA.names)


@query(
    "csv_scan",
    f"""{SV} SELECT icao24, callsign, time_position, last_contact, last_pos_update, latitude, longitude,
    baro_altitude, geo_altitude, velocity, true_track, vertical_rate, on_ground, alert, spi, squawk,
    CAST(json_array_length(sensors) AS INTEGER) AS n_sensors,
    CAST(coalesce(list_sum(from_json(sensors, '["BIGINT"]')), 0) AS BIGINT) AS sensor_sum FROM sv""",
)
def csv_scan(spark, folder):
    path = sinks.export_csv(_as_file(state_vectors(spark, folder)), scratch_path(spark, "csv"))
    df = scan.csv_scan(spark, path, STATE_VECTOR_SCHEMA, {"sensors": "array<bigint>"})
    stamps = {c: F.col(c).cast("timestamp_ntz") for c in ("time_position", "last_contact", "last_pos_update")}
    total = F.aggregate("sensors", F.lit(0).cast("bigint"), lambda a, b: a + b)
    return df.withColumns(stamps).select(
        *[c for c in STATE_VECTOR_SCHEMA.names if c != "sensors"],
        F.size("sensors").alias("n_sensors"),
        total.alias("sensor_sum"),
    )


@query("export_csv", f"{CURATED} SELECT flight_phase, count(*) AS n_rows, max(velocity) AS max_velocity FROM cur GROUP BY 1")
def export_csv(spark, folder):
    result = curated(spark, folder).groupBy("flight_phase").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("velocity").alias("max_velocity")
    )
    path = sinks.export_csv(result, scratch_path(spark, "export"))
    return spark.read.schema(result.schema).option("header", True).csv(path)


@query("write_overwrite", f"{CURATED} SELECT {_CURATED_LIST} FROM cur")
def write_overwrite(spark, folder):
    path = scratch_path(spark, "curated")
    # The first version has another schema; the second replaces rows and schema.
    sinks.overwrite(curated(spark, folder).select("icao24", "flight_phase"), path)
    return sinks.overwrite(curated(spark, folder).select(*CURATED_COLUMNS), path)


# The shape of a hint tree.
_LOW = {
    "op": "lessThan",
    "children": [
        {"op": "column", "name": "baro_altitude", "valueType": "double"},
        {"op": "literal", "value": "3000", "valueType": "double"},
    ],
}


@query(
    "scan_json_hint",
    f"""{SV} SELECT event_id, icao24, baro_altitude FROM
    (SELECT * FROM sv ORDER BY event_id LIMIT 1000) WHERE baro_altitude < 3000""",
)
def scan_json_hint(spark, folder):
    df = state_vectors(spark, folder).select("event_id", "icao24", "baro_altitude")
    return scan.hinted_read(df, json.dumps(_LOW), 1000, ["event_id"])


@query(
    "scan_json_hint_pushed",
    """SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem
    WHERE l_quantity < 10 AND NOT (l_returnflag = 'N') AND l_shipdate >= TIMESTAMP '1995-01-01'""",
)
def scan_json_hint_pushed(spark, folder):
    def compare(op, name, kind, value):
        return {
            "op": op,
            "children": [
                {"op": "column", "name": name, "valueType": kind},
                {"op": "literal", "value": value, "valueType": kind},
            ],
        }

    hint = {
        "op": "and",
        "children": [
            compare("lessThan", "l_quantity", "double", "10"),
            {"op": "not", "children": [compare("equal", "l_returnflag", "string", "N")]},
            compare("greaterThanOrEqual", "l_shipdate", "timestamp", "1995-01-01 00:00:00"),
        ],
    }
    return scan.hinted_scan(table(spark, folder, "lineitem"), hint).select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_shipdate"
    )


@query(
    "keyset_page",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE o_orderkey > (SELECT max(o_orderkey) // 2 FROM orders) ORDER BY o_orderkey LIMIT 100""",
)
def keyset_page(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    middle = orders.agg(F.floor(F.max("o_orderkey") / 2)).scalar()
    return scan.keyset_page(orders, "o_orderkey", middle, 100)


@query(
    "keyset_chain",
    """WITH o AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS place, count(*) OVER () AS n FROM orders)
    SELECT CAST(place // greatest(n // 5, 1) AS INTEGER) AS page, o_orderkey, o_totalprice FROM o""",
)
def keyset_chain(spark, folder):
    """The whole table in pages of a fifth of it, cut at counted keys."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    pages = scan.ranged_pages(orders, "o_orderkey", max(1, orders.count() // 5))
    numbered = [page.select(F.lit(i).alias("page"), "*") for i, page in enumerate(pages)]
    return reduce(DataFrame.unionByName, numbered)


_FEATURES_SQL = """SELECT icao24, round(avg(velocity), 6) AS avg_velocity, max(baro_altitude) AS max_baro_altitude,
    min(baro_altitude) AS min_baro_altitude, round(avg(geo_altitude), 6) AS avg_geo_altitude,
    CAST(count(*) AS DOUBLE) AS num_state_vectors FROM cur GROUP BY icao24"""


def rounded_features(df):
    return df.withColumns({c: F.round(c, 6) for c in ("avg_velocity", "avg_geo_altitude")})


@query("publish_snapshot", f"{CURATED} {_FEATURES_SQL}")
def publish_snapshot(spark, folder):
    path = scratch_path(spark, "online")
    features = sinks.keyed_table(entity_features(curated(spark, folder)), scratch_path(spark, "features"), ["icao24"])
    sinks.publish_snapshot(features, path, ["icao24"])
    return rounded_features(sinks.publish_snapshot(features, path, ["icao24"]))


@query("keyed_table", f"{CURATED} {_FEATURES_SQL}")
def keyed_table(spark, folder):
    path = scratch_path(spark, "features")
    sinks.keyed_table(entity_features(state_vectors(spark, folder)), path, ["icao24"])
    return rounded_features(sinks.keyed_table(entity_features(curated(spark, folder)), path, ["icao24"]))


def prediction_log(df):
    """Log records of the altitude rule classifier, one per observation with a velocity."""
    return df.where(F.col("velocity").isNotNull()).select(
        "event_id",
        "icao24",
        *ROW_FEATURES,
        rule_class().alias("predicted_phase"),
        F.col("time_position").alias("created_at"),
    )


def rule_class():
    altitude = F.col("baro_altitude")
    return (
        F.when(altitude < 300, "Ground")
        .when(altitude >= 8000, "Cruise")
        .when(altitude.isNull(), "Cruise")
        .otherwise("Climb")
    )


@query(
    "append_log",
    f"""{SV} SELECT sha256(concat('{{"event_id":"', event_id, '","icao24":"', icao24, '"}}')) AS id, event_id, icao24, baro_altitude,
    geo_altitude, velocity, true_track, {RULE_CLASS} AS predicted_phase, time_position AS created_at
    FROM sv WHERE velocity IS NOT NULL""",
)
def append_log(spark, folder):
    path = scratch_path(spark, "prediction-log")
    log = prediction_log(state_vectors(spark, folder))
    middle = F.lit("2024-01-16").cast("timestamp_ntz")
    early = log.where(F.col("created_at") < middle)
    sinks.append_log(early, path, ["event_id", "icao24"])
    # The first delivery comes a second time, as after a failed acknowledgement.
    sinks.append_log(early, path, ["event_id", "icao24"])
    return sinks.append_log(log.where(F.col("created_at") >= middle), path, ["event_id", "icao24"])


@query(
    "replace_where",
    """SELECT event_id, CAST(ts AS DATE) AS day,
    CASE WHEN CAST(ts AS DATE) >= DATE '2024-01-10' AND CAST(ts AS DATE) < DATE '2024-01-13'
    THEN value * 2 ELSE value END AS value FROM events WHERE CAST(ts AS DATE) <> DATE '2024-01-11'""",
)
def replace_where(spark, folder):
    path = scratch_path(spark, "by-day")
    rows = table(spark, folder, "events").select("event_id", F.to_date("ts").alias("day"), "value")
    sinks.overwrite(rows, path, ["day"])
    # A day without new rows is emptied.
    revised = rows.withColumn("value", F.col("value") * 2).where(F.col("day") != F.lit(date(2024, 1, 11)))
    return sinks.replace_range(revised, path, "day", date(2024, 1, 10), date(2024, 1, 13)).select(
        "event_id", "day", "value"
    )


@query("project", f"{SV} SELECT {_CURATED_LIST} FROM sv")
def project(spark, folder):
    return state_vectors(spark, folder).select(*CURATED_COLUMNS)


@query(
    "time_range",
    f"""{SV} SELECT event_id, time_position FROM sv
    WHERE time_position >= TIMESTAMP '2024-01-10 18:00:00' AND time_position < TIMESTAMP '2024-01-12 18:15:00'""",
)
def time_range_query(spark, folder):
    df = state_vectors(spark, folder).where(time_range("2024-01-10 18:00:00", "2024-01-12 18:15:00"))
    return df.select("event_id", "time_position")


@query(
    "time_of_day",
    f"""{SV} SELECT event_id, time_position FROM sv
    WHERE hour(time_position) * 60 + minute(time_position) >= 720
    AND hour(time_position) * 60 + minute(time_position) < 735""",
)
def time_of_day_query(spark, folder):
    return state_vectors(spark, folder).where(time_of_day(720, 735)).select("event_id", "time_position")


@query("clean_rules", f"{CURATED} SELECT event_id, icao24, flight_phase FROM cur")
def clean_rules(spark, folder):
    df = keep_passing(state_vectors(spark, folder), CURATED_RULES)
    return df.select("event_id", "icao24", flight_phase().alias("flight_phase"))


@query("phase_label", f"{SV} SELECT event_id, {PHASE} AS flight_phase FROM sv")
def phase_label(spark, folder):
    return labelled(spark, folder).select("event_id", "flight_phase")


@query(
    "dropna_any",
    f"""{SV} SELECT event_id, baro_altitude, geo_altitude, velocity, true_track FROM sv
    WHERE baro_altitude IS NOT NULL AND geo_altitude IS NOT NULL AND velocity IS NOT NULL
    AND true_track IS NOT NULL""",
)
def dropna_any(spark, folder):
    return without_nulls(state_vectors(spark, folder).select("event_id", *ROW_FEATURES))


_COMPACT = """CASE WHEN {0} < 1000 THEN CAST({0} AS VARCHAR)
    WHEN round({0} / 1000.0, 1) < 1000 THEN concat(CAST(round({0} / 1000.0, 1) AS VARCHAR), 'K')
    WHEN round({0} / 1000000.0, 1) < 1000 THEN concat(CAST(round({0} / 1000000.0, 1) AS VARCHAR), 'M')
    ELSE concat(CAST(round({0} / 1000000000.0, 1) AS VARCHAR), 'B') END"""


def _kpi_sql(where: str) -> str:
    return f"""{SV}, k AS (SELECT count(*) AS n_rows, count(DISTINCT icao24) AS n_aircraft,
    round(avg(velocity), 1) AS avg_velocity FROM sv WHERE {where})
    SELECT *, {_COMPACT.format('CAST(n_rows AS DOUBLE)').replace('CAST(CAST(n_rows AS DOUBLE) AS VARCHAR)', 'CAST(n_rows AS VARCHAR)')} AS n_rows_text,
    {_COMPACT.format('CAST(n_aircraft AS DOUBLE)').replace('CAST(CAST(n_aircraft AS DOUBLE) AS VARCHAR)', 'CAST(n_aircraft AS VARCHAR)')} AS n_aircraft_text FROM k"""


@query("kpi_tiles", _kpi_sql("true"))
def kpi_tiles_query(spark, folder):
    return kpi_tiles(state_vectors(spark, folder))


@query("kpi_filtered", _kpi_sql("on_ground"))
def kpi_filtered(spark, folder):
    return kpi_tiles(state_vectors(spark, folder).where(F.col("on_ground")))


@query(
    "cross_filter",
    f"""{LABELLED}, sel AS (SELECT * FROM lab WHERE NOT on_ground AND baro_altitude >= 8000)
    SELECT 'phase' AS widget, flight_phase AS item, count(*) AS n_rows FROM sel GROUP BY 2
    UNION ALL SELECT 'hour', CAST(hour(time_position) AS VARCHAR), count(*) FROM sel GROUP BY 2
    UNION ALL SELECT 'altitude_km', CAST(CAST(floor(baro_altitude / 1000) AS BIGINT) AS VARCHAR), count(*) FROM sel GROUP BY 2""",
)
def cross_filter_query(spark, folder):
    selection = ~F.col("on_ground") & (F.col("baro_altitude") >= 8000)
    widgets = {
        "phase": F.col("flight_phase"),
        "hour": F.hour("time_position"),
        "altitude_km": F.floor(F.col("baro_altitude") / 1000),
    }
    return cross_filter(labelled(spark, folder), selection, widgets)


@query(
    "low_altitude",
    f"{SV} SELECT icao24, callsign, time_position, latitude, longitude, baro_altitude FROM sv WHERE baro_altitude < 3000",
)
def low_altitude(spark, folder):
    return scan.low_altitude(state_vectors(spark, folder))


@query(
    "training_projection",
    f"{CURATED} SELECT baro_altitude, geo_altitude, velocity, true_track, flight_phase FROM cur",
)
def training_projection(spark, folder):
    return curated(spark, folder).select(*ROW_FEATURES, "flight_phase")


@query("scalar_time_format", f"{SV} SELECT event_id, strftime(time_position, '%H:%M:%S') AS clock FROM sv")
def scalar_time_format(spark, folder):
    return state_vectors(spark, folder).select("event_id", clock(F.col("time_position")).alias("clock"))


@query(
    "scalar_compact_number",
    f"SELECT o_orderkey, {_COMPACT.format('round(o_totalprice * o_orderkey)')} AS compact FROM orders",
)
def scalar_compact_number(spark, folder):
    amount = F.round(F.col("o_totalprice") * F.col("o_orderkey"))
    return table(spark, folder, "orders").select("o_orderkey", compact_number(amount).alias("compact"))


@query(
    "scalar_grouped_number",
    "SELECT o_orderkey, format('{:,}', CAST(round(o_totalprice * 100) AS BIGINT)) AS grouped FROM orders",
)
def scalar_grouped_number(spark, folder):
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    return table(spark, folder, "orders").select("o_orderkey", grouped_number(cents).alias("grouped"))


@query(
    "identifier_validity",
    f"""{SV} SELECT CASE WHEN icao24 IS NULL THEN 'missing' WHEN regexp_matches(icao24, '^[0-9a-fA-F]{{6}}$')
    THEN 'valid' ELSE 'malformed' END AS icao24_status,
    CASE WHEN callsign IS NULL THEN 'missing' WHEN regexp_matches(callsign, '^[A-Z0-9]{{2,8}} *$')
    THEN 'valid' ELSE 'malformed' END AS callsign_status, count(*) AS n_rows,
    count(DISTINCT rtrim(callsign)) AS n_callsigns FROM sv GROUP BY 1, 2""",
)
def identifier_validity(spark, folder):
    return (
        state_vectors(spark, folder)
        .groupBy(
            address_status(F.col("icao24")).alias("icao24_status"),
            callsign_status(F.col("callsign")).alias("callsign_status"),
        )
        .agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(F.rtrim("callsign")).alias("n_callsigns"))
    )


@query(
    "sensor_array_stats",
    f"""{SV}, x AS (SELECT icao24, unnest(from_json(sensors, '["BIGINT"]')) AS sensor FROM sv)
    SELECT sensor, count(*) AS n_rows, count(DISTINCT icao24) AS n_aircraft FROM x GROUP BY 1""",
)
def sensor_array_stats(spark, folder):
    return sensor_stats(parse_sensors(state_vectors(spark, folder).select("icao24", "sensors")))


@query(
    "sensor_array_size",
    f"""{SV} SELECT CAST(json_array_length(sensors) AS INTEGER) AS n_sensors, count(*) AS n_rows,
    count(*) FILTER (WHERE list_contains(from_json(sensors, '["BIGINT"]'), 1408045066)) AS n_with_sensor
    FROM sv GROUP BY 1""",
)
def sensor_array_size(spark, folder):
    df = parse_sensors(state_vectors(spark, folder).select("sensors"))
    return df.groupBy(F.size("sensors").alias("n_sensors")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.array_contains("sensors", F.lit(1408045066).cast("bigint"))).alias("n_with_sensor"),
    )


