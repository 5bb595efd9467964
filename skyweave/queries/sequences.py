"""Per-entity sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyweave.functions.labels import flight_phase
from skyweave.operators import routes, tracks
from skyweave.operators.sequence import plan_slices
from skyweave.queries.base import PHASE, RULE_CLASS, SV, query
from skyweave.queries.sources import prediction_log
from skyweave.session import materialise
from skyweave.sources.telemetry import state_vectors, table

_RADIUS = "6371008.8"

# Rows a slice may hold in the queries that always slice, so that the path for large inputs runs on small ones too.
SLICE_ROWS = 1_000


def _distance(lat1, lon1, lat2, lon2) -> str:
    return (
        f"(CASE WHEN {lat1} IS NOT NULL THEN 2 * {_RADIUS} * asin(sqrt(least(1.0, pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * "
        f"cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2)))) END)"
    )


@query(
    "random_row_per_key",
    f"""{SV}, picked AS (SELECT *, row_number() OVER (PARTITION BY icao24
    ORDER BY md5(concat(CAST(event_id AS VARCHAR), '|42')), event_id) AS rn
    FROM sv WHERE baro_altitude IS NOT NULL AND velocity IS NOT NULL)
    SELECT icao24, baro_altitude, velocity, {PHASE} AS flight_phase FROM picked
    WHERE rn = 1 AND baro_altitude BETWEEN 0 AND 13000 AND velocity BETWEEN 0 AND 300""",
)
def random_row_per_key(spark, folder):
    known = state_vectors(spark, folder).where(F.col("baro_altitude").isNotNull() & F.col("velocity").isNotNull())
    columns = ["icao24", "event_id", "baro_altitude", "velocity", "on_ground", "vertical_rate"]
    picked = tracks.random_row_per_key(known.select(*columns))
    inside = tracks.in_envelope(picked, {"baro_altitude": (0, 13000), "velocity": (0, 300)})
    return inside.select("icao24", "baro_altitude", "velocity", flight_phase().alias("flight_phase"))


@query(
    "latest_position",
    f"""{SV}, l AS (SELECT *, row_number() OVER (PARTITION BY icao24 ORDER BY time_position DESC, event_id DESC) AS rn
    FROM sv) SELECT icao24, event_id, time_position, latitude, longitude, velocity FROM l WHERE rn = 1""",
)
def latest_position(spark, folder):
    columns = ["icao24", "event_id", "time_position", "latitude", "longitude", "velocity"]
    return tracks.latest_row(state_vectors(spark, folder).select(*columns))


@query(
    "latest_order",
    """SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (SELECT *, row_number() OVER
    (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""",
)
def latest_order(spark, folder):
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return tracks.latest_row(orders, "o_custkey", "o_orderdate", "o_orderkey")


def _located(spark, folder):
    return state_vectors(spark, folder).where(F.col("baro_altitude").isNotNull())


_BUSY = """busy AS (SELECT icao24, count(*) AS n_rows FROM sv WHERE baro_altitude IS NOT NULL
    GROUP BY 1 ORDER BY n_rows DESC, icao24 LIMIT 120)"""


@query("busiest_entities", f"{SV}, {_BUSY} SELECT * FROM busy")
def busiest_entities(spark, folder):
    return tracks.busiest(_located(spark, folder))


@query(
    "busiest_tracks",
    f"""{SV}, {_BUSY} SELECT icao24, callsign, time_position, baro_altitude, latitude, longitude FROM sv
    WHERE baro_altitude IS NOT NULL AND icao24 IN (SELECT icao24 FROM busy)""",
)
def busiest_tracks(spark, folder):
    located = _located(spark, folder)
    columns = ["icao24", "callsign", "time_position", "baro_altitude", "latitude", "longitude"]
    return tracks.tracks_of(located.select(*columns), tracks.busiest(located))


_ALONG = "PARTITION BY icao24 ORDER BY time_position, event_id"
_NUMBERED = f"""n AS (SELECT event_id, icao24, time_position, row_number() OVER ({_ALONG}) AS point_no,
    count(*) OVER (PARTITION BY icao24) AS n_points FROM sv)"""


@query("entity_tracks", f"{SV}, {_NUMBERED} SELECT * FROM n")
def entity_tracks(spark, folder):
    return tracks.chronological(state_vectors(spark, folder).select("event_id", "icao24", "time_position"))


@query("entity_tracks_sliced", f"{SV}, {_NUMBERED} SELECT * FROM n")
def entity_tracks_sliced(spark, folder):
    df = state_vectors(spark, folder).select("event_id", "icao24", "time_position")
    return tracks.chronological(df, slices=plan_slices(df, "time_position", "event_id", SLICE_ROWS))


@query(
    "downsample_tracks",
    f"{SV}, {_NUMBERED} SELECT * FROM n WHERE (point_no - 1) % CAST(ceil(n_points / 20.0) AS BIGINT) = 0",
)
def downsample_tracks(spark, folder):
    return tracks.downsample(state_vectors(spark, folder).select("event_id", "icao24", "time_position"))


_POINTS = 12


@query(
    "keep_shape",
    f"""{SV}, k AS (SELECT event_id, icao24, time_position, velocity, first(event_id) OVER w AS low, last(event_id) OVER w AS high,
      epoch_us(time_position) - epoch_us(first(time_position) OVER w) AS since,
      epoch_us(last(time_position) OVER w) - epoch_us(first(time_position) OVER w) AS len
      FROM sv WHERE velocity IS NOT NULL
      WINDOW w AS ({_ALONG} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
    c AS (SELECT *, since / 1000000.0 AS t, CASE WHEN event_id = low THEN -1 WHEN event_id = high THEN {_POINTS} - 2
      ELSE least(floor(since * {_POINTS - 2} / greatest(len, 1)), {_POINTS} - 3) END AS bucket FROM k),
    b AS (SELECT icao24, bucket, avg(t) AS t, avg(velocity) AS v FROM c GROUP BY 1, 2),
    s AS (SELECT icao24, bucket, lag(t) OVER w AS t0, lag(v) OVER w AS v0, lead(t) OVER w AS t1, lead(v) OVER w AS v1 FROM b
      WINDOW w AS (PARTITION BY icao24 ORDER BY bucket)),
    a AS (SELECT c.*, round(coalesce(abs((c.t - t0) * (v1 - v0) - (t1 - t0) * (velocity - v0)) / 2, 0), 3) AS area
      FROM c JOIN s USING (icao24, bucket)),
    r AS (SELECT *, row_number() OVER (PARTITION BY icao24, bucket ORDER BY area DESC, time_position, event_id) AS n FROM a)
    SELECT event_id, icao24, time_position, velocity FROM r WHERE n = 1""",
)
def keep_shape(spark, folder):
    """Each track's velocity by a few points that keep its shape."""
    df = state_vectors(spark, folder).select("event_id", "icao24", "time_position", "velocity")
    return tracks.keep_shape(df, "velocity", max_points=_POINTS)


_PLACE_DEGREES, _PLACE_ENDS, _PLACE_GAP = 10, 6, 43200


def _place_cell(end: str) -> str:
    return f"""least(CAST(floor(({end}_lat + 90) / {_PLACE_DEGREES}.0) AS BIGINT), {180 // _PLACE_DEGREES - 1}) * {360 // _PLACE_DEGREES}
      + (CAST(floor(({end}_lon + 180) / {_PLACE_DEGREES}.0) AS BIGINT) % {360 // _PLACE_DEGREES} + {360 // _PLACE_DEGREES})
      % {360 // _PLACE_DEGREES} AS {end}"""


@query(
    "route_map",
    f"""WITH RECURSIVE sv AS ({SV} SELECT * FROM sv),
    k AS (SELECT *, lag(time_position) OVER w AS pts FROM sv WHERE latitude IS NOT NULL AND longitude IS NOT NULL WINDOW w AS ({_ALONG})),
    g AS (SELECT *, CASE WHEN pts IS NULL OR epoch_us(time_position) - epoch_us(pts) >= {_PLACE_GAP}000000 THEN 1 ELSE 0 END AS fresh
      FROM k),
    s AS (SELECT *, sum(fresh) OVER ({_ALONG}) AS segment FROM g),
    n AS (SELECT *, row_number() OVER w AS place, count(*) OVER (PARTITION BY icao24, segment) AS points FROM s
      WINDOW w AS (PARTITION BY icao24, segment ORDER BY time_position, event_id)),
    e AS (SELECT icao24, segment, max(latitude) FILTER (WHERE place = 1) AS o_lat, max(longitude) FILTER (WHERE place = 1) AS o_lon,
      max(latitude) FILTER (WHERE place = points) AS d_lat, max(longitude) FILTER (WHERE place = points) AS d_lon
      FROM n WHERE points > 1 GROUP BY 1, 2),
    c AS (SELECT {_place_cell('o')}, {_place_cell('d')} FROM e),
    dense AS (SELECT node FROM (SELECT o AS node FROM c UNION ALL SELECT d FROM c) GROUP BY node HAVING count(*) >= {_PLACE_ENDS}),
    touch AS (SELECT a.node AS a, b.node AS b FROM dense a JOIN dense b ON a.node <> b.node
      AND abs((a.node + 36) // 36 - (b.node + 36) // 36) <= 1
      AND ((a.node + 36) % 36 - (b.node + 36) % 36) IN (-35, -1, 0, 1, 35)),
    reach(a, b) AS (SELECT node, node FROM dense UNION SELECT r.a, t.b FROM reach r JOIN touch t ON t.a = r.b),
    place AS (SELECT a AS node, min(b) AS place FROM reach GROUP BY 1)
    SELECT po.place AS origin, pd.place AS destination, count(*) AS n_flights
    FROM c LEFT JOIN place po ON po.node = c.o LEFT JOIN place pd ON pd.node = c.d GROUP BY 1, 2""",
)
def route_map(spark, folder):
    """Flights between the places where flights begin and end."""
    df = state_vectors(spark, folder).select("event_id", "icao24", "time_position", "latitude", "longitude")
    ends = materialise(routes.segment_ends(df, _PLACE_GAP), "segment-ends")
    return routes.route_map(ends, float(_PLACE_DEGREES), _PLACE_ENDS)


@query(
    "altitude_delta",
    f"""{SV} SELECT event_id, baro_altitude - lag(baro_altitude) OVER ({_ALONG}) AS baro_delta,
    geo_altitude - lag(geo_altitude) OVER ({_ALONG}) AS geo_delta FROM sv""",
)
def altitude_delta(spark, folder):
    df = state_vectors(spark, folder).select("event_id", "icao24", "time_position", "baro_altitude", "geo_altitude")
    changed = tracks.deltas(df, {"baro_delta": "baro_altitude", "geo_delta": "geo_altitude"})
    return changed.select("event_id", "baro_delta", "geo_delta")


def _rolling_sql(hours: int) -> str:
    frame = (
        f"PARTITION BY icao24 ORDER BY time_position RANGE BETWEEN INTERVAL {hours} HOUR PRECEDING AND CURRENT ROW"
    )
    return f"""{SV} SELECT DISTINCT icao24, time_position, count(*) OVER w AS n_obs,
    round(avg(velocity) OVER w, 6) AS avg_velocity FROM sv WINDOW w AS ({frame})"""


def _rolling(spark, folder, hours, sliced=False):
    df = state_vectors(spark, folder).select("icao24", "time_position", "velocity")
    slices = plan_slices(df, "time_position", target_rows=SLICE_ROWS) if sliced else None
    rolled = tracks.rolling_features(df, hours * 3600, slices=slices)
    return rolled.withColumn("avg_velocity", F.round("avg_velocity", 6))


@query("rolling_features", _rolling_sql(1))
def rolling_features(spark, folder):
    return _rolling(spark, folder, 1)


@query("rolling_features_day", _rolling_sql(24))
def rolling_features_day(spark, folder):
    return _rolling(spark, folder, 24)


@query("rolling_features_sliced", _rolling_sql(24))
def rolling_features_sliced(spark, folder):
    return _rolling(spark, folder, 24, sliced=True)


@query(
    "stale_fix",
    f"""{SV} SELECT event_id, last_pos_update,
    coalesce(lag(last_pos_update) OVER ({_ALONG}) = last_pos_update, false) AS is_stale FROM sv""",
)
def stale_fix(spark, folder):
    df = state_vectors(spark, folder).select("event_id", "icao24", "time_position", "last_pos_update")
    return tracks.stale_fixes(df).select("event_id", "last_pos_update", "is_stale")


@query(
    "glyph_points",
    f"""{SV}, {_BUSY}, t AS (SELECT event_id, icao24, time_position, baro_altitude FROM sv
    WHERE baro_altitude IS NOT NULL AND icao24 IN (SELECT icao24 FROM busy))
    SELECT event_id, icao24,
    round(2 * pi() * (hour(time_position) * 3600 + minute(time_position) * 60 + second(time_position)) / 86400.0, 6) AS angle,
    round((baro_altitude - (SELECT min(baro_altitude) FROM t)) /
    ((SELECT max(baro_altitude) FROM t) - (SELECT min(baro_altitude) FROM t)), 6) AS radius,
    CASE WHEN baro_altitude < 3000 THEN 'low' WHEN baro_altitude < 9000 THEN 'medium' ELSE 'high' END AS band FROM t""",
)
def glyph_points(spark, folder):
    located = _located(spark, folder).select("event_id", "icao24", "time_position", "baro_altitude")
    glyphs = tracks.glyph_points(tracks.tracks_of(located, tracks.busiest(located)))
    return glyphs.select(
        "event_id", "icao24", F.round("angle", 6).alias("angle"), F.round("radius", 6).alias("radius"), "band"
    )


def _loops_sql(seconds: int) -> str:
    return f"""{SV}, p AS (SELECT icao24, time_position, true_track, lag(true_track) OVER ({_ALONG}) AS was
    FROM sv WHERE true_track IS NOT NULL),
    d AS (SELECT icao24, time_position,
    CAST(coalesce((true_track - was + 540.0) % 360.0 - 180.0, 0.0) AS DECIMAL(28, 9)) AS turn FROM p),
    s AS (SELECT DISTINCT icao24, time_position, sum(turn) OVER (PARTITION BY icao24 ORDER BY time_position
    RANGE BETWEEN INTERVAL {seconds} SECOND PRECEDING AND CURRENT ROW) AS turned FROM d)
    SELECT icao24, time_position, round(CAST(turned AS DOUBLE), 6) AS turn_degrees FROM s WHERE abs(turned) >= 360"""


def _loops(spark, folder, seconds):
    df = state_vectors(spark, folder).select("event_id", "icao24", "time_position", "true_track")
    return tracks.holding_loops(df, seconds).withColumn("turn_degrees", F.round("turn_degrees", 6))


@query("holding_loops", _loops_sql(1200))
def holding_loops(spark, folder):
    return _loops(spark, folder, 1200)


@query("holding_loops_long", _loops_sql(172800))
def holding_loops_long(spark, folder):
    return _loops(spark, folder, 172800)


def _segments_sql(gap: int) -> str:
    return f"""{SV}, k AS (SELECT *, lag(latitude) OVER w AS plat, lag(longitude) OVER w AS plon,
    lag(time_position) OVER w AS pts FROM sv WHERE latitude IS NOT NULL AND longitude IS NOT NULL
    WINDOW w AS ({_ALONG})),
    g AS (SELECT *, CASE WHEN pts IS NULL OR epoch_us(time_position) - epoch_us(pts) >= {gap}000000 THEN 1 ELSE 0 END AS fresh,
    {_distance('plat', 'plon', 'latitude', 'longitude')} AS step FROM k),
    s AS (SELECT *, sum(fresh) OVER ({_ALONG}) AS segment FROM g)
    SELECT icao24, CAST(segment AS BIGINT) AS segment, min(time_position) AS start_ts, max(time_position) AS end_ts,
    count(*) AS n_points, (epoch_us(max(time_position)) - epoch_us(min(time_position))) / 1000000.0 AS duration_s,
    round(coalesce(sum(step) FILTER (WHERE fresh = 0), 0.0) / 1000.0, 3) AS length_km FROM s GROUP BY 1, 2"""


def _routes(spark, folder, gap, sliced=False):
    df = state_vectors(spark, folder).select("event_id", "icao24", "time_position", "latitude", "longitude")
    slices = plan_slices(df, "time_position", "event_id", SLICE_ROWS) if sliced else None
    return tracks.segment_routes(df, gap, slices=slices).withColumn("length_km", F.round("length_km", 3))


@query("flight_segments", _segments_sql(1800))
def flight_segments(spark, folder):
    return _routes(spark, folder, 1800)


@query("flight_segments_long", _segments_sql(43200))
def flight_segments_long(spark, folder):
    return _routes(spark, folder, 43200)


@query("flight_segments_sliced", _segments_sql(43200))
def flight_segments_sliced(spark, folder):
    return _routes(spark, folder, 43200, sliced=True)


@query(
    "step_distance",
    f"""{SV}, k AS (SELECT *, lag(latitude) OVER w AS plat, lag(longitude) OVER w AS plon,
    lag(time_position) OVER w AS pts FROM sv WHERE latitude IS NOT NULL AND longitude IS NOT NULL
    WINDOW w AS ({_ALONG})),
    d AS (SELECT *, {_distance('plat', 'plon', 'latitude', 'longitude')} AS step,
    (epoch_us(time_position) - epoch_us(pts)) / 1000000.0 AS secs FROM k)
    SELECT event_id, round(step / 1000, 3) AS step_km, round(CASE WHEN secs > 0 THEN step / secs END, 3) AS implied_mps,
    round(CASE WHEN secs > 0 THEN step / secs END - velocity, 3) AS speed_gap FROM d""",
)
def step_distance(spark, folder):
    columns = ["event_id", "icao24", "time_position", "latitude", "longitude", "velocity"]
    stepped = tracks.steps(state_vectors(spark, folder).select(*columns))
    return stepped.select(
        "event_id",
        F.round(F.col("step_m") / 1000, 3).alias("step_km"),
        F.round("implied_mps", 3).alias("implied_mps"),
        F.round(F.col("implied_mps") - F.col("velocity"), 3).alias("speed_gap"),
    )


@query(
    "recent_n",
    f"""{SV} SELECT icao24, {RULE_CLASS} AS predicted_phase, velocity, baro_altitude, time_position AS created_at
    FROM sv WHERE velocity IS NOT NULL ORDER BY time_position DESC, event_id LIMIT 50""",
)
def recent_n(spark, folder):
    log = prediction_log(state_vectors(spark, folder))
    return (
        log.orderBy(F.desc("created_at"), "event_id")
        .limit(50)
        .select("icao24", "predicted_phase", "velocity", "baro_altitude", "created_at")
    )


