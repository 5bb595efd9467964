"""Region bands and the medallion flow."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyweave.operators import regions
from skyweave.operators.rules import SILVER_DROP, keep_passing
from skyweave.plans import medallion
from skyweave.queries.base import BAND, SILVER, SV, band_union, query
from skyweave.queries.quality import expectation_sql
from skyweave.sources.telemetry import events_path, state_vectors


@query("region_filter", f"{SV} SELECT event_id, longitude FROM sv WHERE {BAND['APAC']}")
def region_filter(spark, folder):
    return state_vectors(spark, folder).where(regions.in_region("APAC")).select("event_id", "longitude")


@query("region_fanout", f"{SV} {band_union('sv', 'event_id, longitude')}")
def region_fanout(spark, folder):
    return regions.route(state_vectors(spark, folder)).select("event_id", "longitude", "region")


_FIRST = " ".join(f"WHEN {text} THEN '{name}'" for name, text in BAND.items())


@query(
    "region_exclusive",
    f"""{SV}, x AS (SELECT event_id, longitude, CASE {_FIRST} END AS region FROM sv)
    SELECT * FROM x WHERE region IS NOT NULL""",
)
def region_exclusive(spark, folder):
    return regions.route(state_vectors(spark, folder), "exclusive").select("event_id", "longitude", "region")


def _silver(spark, folder):
    return keep_passing(state_vectors(spark, folder), SILVER_DROP)


@query("region_union", f"{SILVER} {band_union('silver', 'event_id, icao24, longitude')}")
def region_union(spark, folder):
    silver = _silver(spark, folder).select("event_id", "icao24", "longitude")
    return regions.union_tagged({r: silver.where(regions.in_region(r)) for r in regions.BANDS})


@query(
    "region_overlap",
    f"""{SV}, x AS (SELECT concat_ws('+', {', '.join(f"CASE WHEN {t} THEN '{n}' END" for n, t in BAND.items())}) AS regions,
    {' + '.join(f"coalesce(CAST({t} AS INT), 0)" for t in BAND.values())} AS n_regions FROM sv)
    SELECT regions, CAST(n_regions AS INTEGER) AS n_regions, count(*) AS n_rows FROM x GROUP BY 1, 2""",
)
def region_overlap(spark, folder):
    return regions.overlap_audit(state_vectors(spark, folder))


_SUMMARY = """SELECT region, count(*) AS n_rows, count(DISTINCT icao24) AS n_aircraft,
    round(avg(velocity), 6) AS avg_velocity, round(avg(baro_altitude), 6) AS avg_baro_altitude,
    max(baro_altitude) AS max_baro_altitude, count(*) FILTER (WHERE on_ground) AS n_on_ground,
    min(time_position) AS first_seen, max(time_position) AS last_seen FROM gold GROUP BY 1"""


@query("regional_summary", f"{SILVER}, gold AS ({band_union('silver', '*')}) {_SUMMARY}")
def regional_summary(spark, folder):
    return regions.regional_summary(regions.route(_silver(spark, folder)))


@query(
    "medallion_gold",
    f"""{SILVER} {band_union("silver", '''event_id, icao24, time_position, velocity,
    concat_ws(',', CASE WHEN NOT coalesce(geo_altitude IS NULL OR geo_altitude BETWEEN -500 AND 50000, false)
    THEN 'reasonable_geo_altitude' END, CASE WHEN NOT coalesce(true_track IS NULL OR
    (true_track >= 0 AND true_track < 360), false) THEN 'valid_track' END) AS warnings''')}""",
)
def medallion_gold(spark, folder):
    tables = medallion.build(spark, events_path(folder))
    return medallion.read_gold(spark, tables).select(
        "event_id", "icao24", "time_position", "velocity", F.concat_ws(",", "warnings").alias("warnings"), "region"
    )


_NOON = """(SELECT * FROM silver WHERE hour(time_position) * 60 + minute(time_position) >= 720
    AND hour(time_position) * 60 + minute(time_position) < 735)"""


@query("medallion_summary", f"{SILVER}, noon AS {_NOON}, gold AS ({band_union('noon', '*')}) {_SUMMARY}")
def medallion_summary(spark, folder):
    scope = medallion.time_of_day(720, 735)
    tables = medallion.build(spark, events_path(folder), scope=scope)
    return medallion.read_summary(spark, tables)


@query("medallion_expectations", expectation_sql("sv"))
def medallion_expectations(spark, folder):
    return medallion.read_expectations(spark, medallion.build(spark, events_path(folder)))
