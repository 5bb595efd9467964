"""Profiles, dashboard datasets and metric views."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from skyweave.operators import metrics, profile
from skyweave.queries.base import CURATED, LABELLED, SV, curated, labelled, query
from skyweave.sources.telemetry import state_vectors, table


@query("row_count", f"{CURATED} SELECT count(*) AS n_rows FROM cur")
def row_count(spark, folder):
    return profile.row_count(curated(spark, folder))


@query(
    "class_balance",
    f"""{CURATED} SELECT flight_phase, count(*) AS n_rows,
    round(100.0 * count(*) / (SELECT count(*) FROM cur), 3) AS pct FROM cur GROUP BY 1""",
)
def class_balance(spark, folder):
    return profile.shares(curated(spark, folder), "flight_phase")


def _summary_sql(source: str, columns) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count({c}) AS n_values, round(avg({c}), 4) AS mean, "
        f"round(stddev({c}), 4) AS stddev, min({c}) AS min, round(quantile_cont({c}, 0.01), 4) AS p01, "
        f"round(quantile_cont({c}, 0.5), 4) AS p50, round(quantile_cont({c}, 0.99), 4) AS p99, max({c}) AS max "
        f"FROM {source}"
        for c in columns
    )


@query("feature_summary", f"{CURATED} {_summary_sql('cur', profile.FEATURES)}")
def feature_summary(spark, folder):
    return profile.feature_summary(curated(spark, folder), exact=True)


@query("feature_summary_sliced", f"{CURATED} {_summary_sql('cur', profile.FEATURES)}")
def feature_summary_sliced(spark, folder):
    return profile.feature_summary(curated(spark, folder), exact=True, whole_group=0, target_rows=1_000)


@query("feature_summary_approx")
def feature_summary_approx(spark, folder):
    return profile.feature_summary(curated(spark, folder))


_MONEY = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("feature_summary_lineitem", _summary_sql("lineitem", _MONEY))
def feature_summary_lineitem(spark, folder):
    return profile.feature_summary(table(spark, folder, "lineitem"), _MONEY, exact=True)


@query(
    "extents",
    f"""{CURATED} SELECT min(latitude) AS lat_min, max(latitude) AS lat_max, min(longitude) AS lon_min,
    max(longitude) AS lon_max, min(time_position) AS ts_min, max(time_position) AS ts_max FROM cur""",
)
def extents(spark, folder):
    return profile.extents(curated(spark, folder), {"lat": "latitude", "lon": "longitude", "ts": "time_position"})


@query("per_minute", f"{CURATED} SELECT strftime(time_position, '%H:%M') AS minute, count(*) AS n_rows FROM cur GROUP BY 1")
def per_minute(spark, folder):
    return profile.per_minute(curated(spark, folder))


@query("hourly_volume", f"{SV} SELECT CAST(hour(time_position) AS INTEGER) AS hour, count(*) AS n_rows FROM sv GROUP BY 1")
def hourly_volume(spark, folder):
    return profile.hourly_volume(state_vectors(spark, folder))


@query(
    "feature_by_class",
    f"""{CURATED} SELECT flight_phase, round(avg(baro_altitude), 1) AS avg_baro_altitude,
    round(avg(geo_altitude), 1) AS avg_geo_altitude, round(avg(velocity), 1) AS avg_velocity,
    round(avg(true_track), 1) AS avg_true_track FROM cur GROUP BY 1""",
)
def feature_by_class(spark, folder):
    return profile.group_means(curated(spark, folder), "flight_phase")


@query("distinct_values", f"{LABELLED} SELECT DISTINCT flight_phase FROM lab")
def distinct_values(spark, folder):
    return profile.distinct_values(labelled(spark, folder), "flight_phase")


@query("distinct_count", f"{SV} SELECT count(DISTINCT icao24) AS n_icao24 FROM sv")
def distinct_count(spark, folder):
    return profile.distinct_count(state_vectors(spark, folder))


@query("distinct_approx")
def distinct_approx(spark, folder):
    return profile.distinct_count(state_vectors(spark, folder), approximate=True)


@query(
    "altitude_histogram",
    f"""{SV} SELECT CAST(floor(baro_altitude / 1000) * 1000 AS DOUBLE) AS bin_start, count(*) AS n_rows
    FROM sv WHERE NOT on_ground AND baro_altitude IS NOT NULL GROUP BY 1""",
)
def altitude_histogram(spark, folder):
    airborne = state_vectors(spark, folder).where(~F.col("on_ground"))
    return profile.histogram(airborne, "baro_altitude", 1000)


@query(
    "velocity_buckets",
    f"""{SV} SELECT CASE WHEN velocity < 0 THEN 0 WHEN velocity >= 400 THEN 21
    ELSE CAST(floor(velocity / 20) AS BIGINT) + 1 END AS bucket, count(*) AS n_rows
    FROM sv WHERE velocity IS NOT NULL GROUP BY 1""",
)
def velocity_buckets(spark, folder):
    return profile.bucket_histogram(state_vectors(spark, folder), "velocity", 0.0, 400.0, 20)


def _box_sql(prelude: str, source: str, column: str, by: str) -> str:
    return f"""{prelude} q AS (SELECT {by}, quantile_cont({column}, 0.25) AS a, quantile_cont({column}, 0.5) AS b,
    quantile_cont({column}, 0.75) AS c FROM {source} GROUP BY 1),
    f AS (SELECT *, a - 1.5 * (c - a) AS lo, c + 1.5 * (c - a) AS hi FROM q)
    SELECT {by}, count(*) AS n_values, round(max(a), 6) AS q1, round(max(b), 6) AS median, round(max(c), 6) AS q3,
    round(max(lo), 6) AS fence_low, round(max(hi), 6) AS fence_high,
    min({column}) FILTER (WHERE {column} BETWEEN lo AND hi) AS whisker_low,
    max({column}) FILTER (WHERE {column} BETWEEN lo AND hi) AS whisker_high,
    count(*) FILTER (WHERE NOT ({column} BETWEEN lo AND hi)) AS n_outliers
    FROM {source} JOIN f USING ({by}) WHERE {column} IS NOT NULL GROUP BY 1"""


@query("box_plot", _box_sql(f"{LABELLED},", "lab", "velocity", "flight_phase"))
def box_plot(spark, folder):
    return profile.box_plot(labelled(spark, folder), "velocity", "flight_phase")


@query("box_plot_lineitem", _box_sql("WITH", "lineitem", "l_extendedprice", "l_returnflag"))
def box_plot_lineitem(spark, folder):
    return profile.box_plot(table(spark, folder, "lineitem"), "l_extendedprice", "l_returnflag")


def _extreme_sql(title: str, column: str, direction: str) -> str:
    return (
        f"SELECT * FROM (SELECT '{title}' AS record, icao24, event_id AS row_id, time_position AS seen, "
        f"{column} AS value FROM sv WHERE {column} IS NOT NULL ORDER BY {column} {direction}, event_id LIMIT 1)"
    )


@query(
    "extreme_records",
    f"""{SV} {_extreme_sql('fastest', 'velocity', 'DESC')} UNION ALL
    {_extreme_sql('highest', 'baro_altitude', 'DESC')} UNION ALL
    {_extreme_sql('fastest_descent', 'vertical_rate', 'ASC')}""",
)
def extreme_records(spark, folder):
    return profile.extreme_records(state_vectors(spark, folder))


_CELL = """CAST(floor((latitude + 90) / 1.0) AS BIGINT) AS cell_row,
    CAST(floor((longitude + 180) / 1.0) AS BIGINT) AS cell_col"""


@query(
    "grid_density",
    f"""{SV} SELECT {_CELL}, count(*) AS n_rows, count(DISTINCT icao24) AS n_aircraft FROM sv
    WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY 1, 2""",
)
def grid_density(spark, folder):
    return profile.grid_density(state_vectors(spark, folder))


@query(
    "grid_density_time",
    f"""{SV} SELECT {_CELL.replace('1.0', '10.0')}, CAST(hour(time_position) AS INTEGER) AS slice_hour,
    CAST(time_position AS DATE) AS slice_date, count(*) AS n_rows, count(DISTINCT icao24) AS n_aircraft FROM sv
    WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY 1, 2, 3, 4""",
)
def grid_density_time(spark, folder):
    return profile.grid_density(state_vectors(spark, folder), degrees=10.0, slice_hours=1)


def _hex_sql(x: str, y: str, columns: int) -> str:
    """Cell of a point in hexagon widths, as hex_column and hex_row."""
    return f"""p AS (SELECT *, {x} - {y} / {math.sqrt(3) / 2} / 2 AS u, {y} / {math.sqrt(3) / 2} AS v FROM xy),
    r AS (SELECT *, floor(u + 0.5) AS a, floor(v + 0.5) AS b, floor(-u - v + 0.5) AS c FROM p),
    f AS (SELECT *, abs(a - u) AS du, abs(b - v) AS dv, abs(c - (-u - v)) AS dw FROM r),
    h AS (SELECT *, CAST(CASE WHEN du > dv AND du > dw THEN -b - c ELSE a END AS BIGINT) AS q,
      CAST(CASE WHEN NOT (du > dv AND du > dw) AND dv > dw THEN -a - c ELSE b END AS BIGINT) AS hex_row FROM f),
    cells AS (SELECT *, (q % {columns} + {columns}) % {columns} AS hex_column FROM h)"""


_HEX_COLUMNS, _HEX_COARSER = 72, 18
_HEX = f"""{SV}, m AS (SELECT icao24, (longitude + 180) % 360 AS m, sin(radians(greatest(-90.0, least(90.0, latitude)))) AS north
      FROM sv WHERE latitude IS NOT NULL AND longitude IS NOT NULL),
    xy AS (SELECT icao24, (CASE WHEN m < 0 THEN (m + 360) % 360 ELSE m END) / 360 * {_HEX_COLUMNS} AS x,
      north * {_HEX_COLUMNS / (2 * math.pi)} AS y FROM m), {_hex_sql("x", "y", _HEX_COLUMNS)},
    density AS (SELECT hex_column, hex_row, count(*) AS n_rows, count(DISTINCT icao24) AS n_aircraft FROM cells GROUP BY 1, 2)"""
_HEX_SCALE = _HEX_COARSER / _HEX_COLUMNS


@query("hex_density", f"{_HEX} SELECT * FROM density")
def hex_density(spark, folder):
    return profile.hex_density(state_vectors(spark, folder), _HEX_COLUMNS)


@query(
    "hex_rollup",
    f"""WITH density AS ({_HEX} SELECT * FROM density),
    w AS (SELECT n_rows, ((hex_column + hex_row / 2.0) * {_HEX_SCALE}) % {_HEX_COARSER} AS m, hex_row * {math.sqrt(3) / 2 * _HEX_SCALE} AS y
      FROM density),
    xy AS (SELECT n_rows, CASE WHEN m < 0 THEN (m + {_HEX_COARSER}) % {_HEX_COARSER} ELSE m END AS x, y FROM w),
    {_hex_sql("x", "y", _HEX_COARSER)}
    SELECT hex_column, hex_row, CAST(sum(n_rows) AS BIGINT) AS n_rows, count(*) AS n_children FROM cells GROUP BY 1, 2""",
)
def hex_rollup(spark, folder):
    cells = profile.hex_density(state_vectors(spark, folder), _HEX_COLUMNS)
    return profile.hex_rollup(cells, _HEX_COLUMNS, _HEX_COARSER)


@query(
    "phase_mix",
    f"{LABELLED} SELECT flight_phase, count(*) AS n_rows FROM lab GROUP BY 1",
)
def phase_mix(spark, folder):
    return profile.shares(labelled(spark, folder), "flight_phase").drop("pct")


def telemetry_metrics() -> metrics.MetricView:
    """The measures and dimensions of the state vectors."""
    return metrics.MetricView(
        measures={
            "n_rows": F.count(F.lit(1)),
            "n_aircraft": F.count_distinct("icao24"),
            "avg_velocity": F.round(F.avg("velocity"), 6),
            "ground_share": F.round(F.avg(F.col("on_ground").cast("int")), 6),
        },
        dimensions={
            "phase": F.col("flight_phase"),
            "hour": F.hour("time_position"),
            "day": F.to_date("time_position"),
        },
    )


@query(
    "metric_view",
    f"""{LABELLED} SELECT flight_phase AS phase, CAST(hour(time_position) AS INTEGER) AS hour, count(*) AS n_rows,
    count(DISTINCT icao24) AS n_aircraft, round(avg(velocity), 6) AS avg_velocity,
    round(avg(CAST(on_ground AS INT)), 6) AS ground_share FROM lab GROUP BY 1, 2""",
)
def metric_view(spark, folder):
    return telemetry_metrics().by(labelled(spark, folder), "phase", "hour")


@query(
    "metric_cube",
    f"""{LABELLED}, d AS (SELECT *, flight_phase AS phase, CAST(hour(time_position) AS INTEGER) AS hour FROM lab)
    SELECT phase, hour, count(*) AS n_rows, round(avg(velocity), 6) AS avg_velocity,
    CAST(grouping(phase, hour) AS INTEGER) AS level FROM d GROUP BY CUBE (phase, hour)""",
)
def metric_cube(spark, folder):
    return telemetry_metrics().cube(labelled(spark, folder), "phase", "hour", measures=["n_rows", "avg_velocity"])


@query(
    "metric_alert",
    f"""{LABELLED}, m AS (SELECT CAST(time_position AS DATE) AS day, round(avg(velocity), 6) AS avg_velocity
    FROM lab GROUP BY 1)
    SELECT day, 'avg_velocity' AS metric, avg_velocity AS value, CAST(50.0 AS DOUBLE) AS threshold
    FROM m WHERE avg_velocity > 50""",
)
def metric_alert(spark, folder):
    daily = telemetry_metrics().by(labelled(spark, folder), "day", measures=["avg_velocity"])
    return metrics.threshold_alerts(daily, "avg_velocity", 50.0)


_SHIFT = f"""{SV}, c AS (SELECT CAST(floor(baro_altitude / 1000) * 1000 AS DOUBLE) AS bin_start,
    count(*) FILTER (WHERE time_position < TIMESTAMP '2024-01-16') AS r,
    count(*) FILTER (WHERE NOT (time_position < TIMESTAMP '2024-01-16')) AS k
    FROM sv WHERE baro_altitude IS NOT NULL GROUP BY 1),
    p AS (SELECT *, (r + 0.5) / (sum(r) OVER () + 0.5 * count(*) OVER ()) AS pr,
    (k + 0.5) / (sum(k) OVER () + 0.5 * count(*) OVER ()) AS pk FROM c)"""


def _shift(spark, folder):
    early = F.col("time_position") < F.lit("2024-01-16").cast("timestamp_ntz")
    return metrics.population_shift(state_vectors(spark, folder), early, "baro_altitude", 1000.0)


@query(
    "drift_psi",
    f"""{_SHIFT} SELECT round(sum((pk - pr) * ln(pk / pr)), 6) AS psi,
    sum((pk - pr) * ln(pk / pr)) > 0.2 AS drifted, count(*) AS n_bins FROM p""",
)
def drift_psi(spark, folder):
    return metrics.stability_index(_shift(spark, folder))


@query(
    "drift_bins",
    f"""{_SHIFT} SELECT bin_start, r AS n_reference, k AS n_current, round((pk - pr) * ln(pk / pr), 8) AS psi FROM p""",
)
def drift_bins(spark, folder):
    return _shift(spark, folder).select("bin_start", "n_reference", "n_current", F.round("psi", 8).alias("psi"))


