"""Streams over the events table, run until the stored data is used up."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyweave.functions.labels import PHASES, flight_phase
from skyweave.operators.rules import CURATED_RULES, SILVER_DROP, SILVER_WARN, keep_passing
from skyweave.plans import learning
from skyweave.queries import change_data  # noqa: F401
from skyweave.queries.base import CURATED, ORACLES, PHASE, RULE_CLASS, SILVER, SV, query
from skyweave.queries.learning import MODEL, registered
from skyweave.queries.quality import expectation_sql
from skyweave.session import scratch_path
from skyweave.queries.sources import prediction_log, rule_class
from skyweave.sources import sinks
from skyweave.sources.telemetry import events_path, state_vectors, table, to_state_vectors
from skyweave.streaming import history, ingest, live, run, tables, windows

DELAY = "1 hour"
_CLOSED = "(SELECT max(ts) - INTERVAL 1 HOUR FROM events)"


def _events(spark, folder):
    return run.file_stream(spark, events_path(folder))


def _vectors(spark, folder):
    return to_state_vectors(_events(spark, folder))


def _timed(spark, folder):
    return run.event_time(_vectors(spark, folder), "time_position", DELAY)


@query("stream_file_ingest", "SELECT * FROM events")
def stream_file_ingest(spark, folder):
    return run.drain(_events(spark, folder), "ingest")


@query("append_flow", "SELECT event_id, ts, user_id, value FROM events")
def append_flow(spark, folder):
    events = table(spark, folder, "events").select("event_id", "ts", "user_id", "value")
    landing, target, checkpoint = (scratch_path(spark, n) for n in ("landing", "appended", "appended-checkpoint"))
    middle = F.lit("2024-01-16").cast("timestamp_ntz")
    # Two deliveries; the second run must add the second one only.
    for delivery in (events.where(F.col("ts") < middle), events.where(~(F.col("ts") < middle))):
        delivery.write.mode("append").parquet(landing)
        run.to_table(run.file_stream(spark, landing), target, checkpoint)
    return spark.read.parquet(target)


@query("stream_silver", f"{SILVER} SELECT event_id, icao24, time_position, velocity, latitude FROM silver")
def stream_silver(spark, folder):
    cleaned = tables.silver(_vectors(spark, folder), SILVER_DROP)
    return run.drain(cleaned.select("event_id", "icao24", "time_position", "velocity", "latitude"), "silver")


@query(
    "stream_tumbling",
    f"""{SV}, w AS (SELECT date_trunc('day', time_position) AS window_start, count(*) AS n_rows,
    count(velocity) AS n_velocity FROM sv GROUP BY 1)
    SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, n_rows, n_velocity FROM w
    WHERE window_start + INTERVAL 1 DAY <= {_CLOSED}""",
)
def stream_tumbling(spark, folder):
    return run.zone_free(run.drain(windows.tumbling_counts(_timed(spark, folder)), "tumbling"))


@query(
    "stream_sliding",
    f"""{SV}, w AS (SELECT icao24, date_trunc('hour', time_position) - to_hours(o) AS window_start, baro_altitude, velocity
    FROM sv, (VALUES (0), (1)) AS back(o))
    SELECT icao24, window_start, window_start + INTERVAL 2 HOUR AS window_end, count(*) AS n_rows,
    max(baro_altitude) AS max_baro_altitude, round(avg(velocity), 6) AS avg_velocity FROM w
    WHERE window_start + INTERVAL 2 HOUR <= {_CLOSED} GROUP BY 1, 2, 3""",
)
def stream_sliding(spark, folder):
    return run.zone_free(run.drain(windows.sliding_features(_timed(spark, folder)), "sliding"))


@query(
    "stream_sessions",
    f"""{SV}, g AS (SELECT *, CASE WHEN time_position - lag(time_position) OVER w < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh
    FROM sv WINDOW w AS (PARTITION BY icao24 ORDER BY time_position, event_id)),
    s AS (SELECT *, sum(fresh) OVER (PARTITION BY icao24 ORDER BY time_position, event_id) AS n FROM g),
    r AS (SELECT icao24, min(time_position) AS session_start, max(time_position) + INTERVAL 30 MINUTE AS session_end,
    count(*) AS n_rows FROM s GROUP BY icao24, n)
    SELECT * FROM r WHERE session_end <= {_CLOSED}""",
)
def stream_sessions(spark, folder):
    with windows.local_session_merge(spark):
        return run.zone_free(run.drain(windows.flight_sessions(_timed(spark, folder)), "sessions"))


@query(
    "stream_latest",
    f"""{SV}, l AS (SELECT *, row_number() OVER (PARTITION BY icao24 ORDER BY time_position DESC, event_id DESC) AS rn FROM sv)
    SELECT icao24, event_id, time_position, latitude, longitude FROM l WHERE rn = 1""",
)
def stream_latest(spark, folder):
    columns = ["icao24", "event_id", "time_position", "latitude", "longitude"]
    return tables.latest_positions(_vectors(spark, folder).select(*columns), scratch_path(spark, "latest"))


@query("stream_dedupe", f"{SV} SELECT event_id, icao24, time_position FROM sv")
def stream_dedupe(spark, folder):
    once = _vectors(spark, folder).select("event_id", "icao24", "time_position")
    replayed = once.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(2)))).drop("copy")
    timed = run.event_time(windows.thinned(replayed, "event_id"), "time_position", DELAY)
    return run.zone_free(run.drain(windows.without_repeats(timed, "event_id"), "dedupe"))


@query("stream_score", f"{CURATED} SELECT event_id, icao24, flight_phase, true AS has_label FROM cur")
def stream_score(spark, folder):
    model, _ = registered(spark, folder).load(MODEL, "prod")
    rows = keep_passing(_vectors(spark, folder), CURATED_RULES).withColumn("flight_phase", flight_phase())
    scored = learning.score(model, rows).select("event_id", "icao24", "flight_phase", "flight_phase_pred")
    labelled = F.coalesce(F.col("flight_phase_pred").isin(*PHASES), F.lit(False))
    return run.drain(scored, "scored").select("event_id", "icao24", "flight_phase", labelled.alias("has_label"))


@query("stream_expectations", expectation_sql("sv"))
def stream_expectations(spark, folder):
    return tables.expectation_counters(
        _vectors(spark, folder), SILVER_DROP + SILVER_WARN, scratch_path(spark, "expectations")
    )


@query(
    "stream_append_log",
    f"""{SV} SELECT sha256(concat('{{"event_id":"', event_id, '","icao24":"', icao24, '"}}')) AS id, event_id, icao24,
    {RULE_CLASS} AS predicted_phase FROM sv WHERE velocity IS NOT NULL""",
)
def stream_append_log(spark, folder):
    root = scratch_path(spark, "stream-log")

    def prepare(batch):
        records = prediction_log(batch).select("event_id", "icao24", "predicted_phase")
        return sinks.with_record_id(records, ["event_id", "icao24"])

    # The second run finds nothing new and adds nothing.
    tables.append_batches(_vectors(spark, folder), prepare, root)
    return tables.append_batches(_vectors(spark, folder), prepare, root)


@query(
    "feedback_append",
    f"""{SV} SELECT sha256(concat('{{"prediction_id":"', event_id, '"}}')) AS id, event_id AS prediction_id,
    ({PHASE}) = ({RULE_CLASS}) AS is_correct, {PHASE} AS correct_phase FROM sv
    WHERE vertical_rate IS NOT NULL AND velocity IS NOT NULL""",
)
def feedback_append(spark, folder):
    """Feedback on logged predictions, delivered twice; feedback on predictions nobody logged is refused."""
    path = scratch_path(spark, "feedback")
    seen = state_vectors(spark, folder).where(F.col("vertical_rate").isNotNull())
    feedback = seen.select(
        F.col("event_id").alias("prediction_id"),
        (flight_phase() == rule_class()).alias("is_correct"),
        flight_phase().alias("correct_phase"),
    )
    log = prediction_log(state_vectors(spark, folder)).select(F.col("event_id").alias("prediction_id"))
    known = feedback.join(log, "prediction_id", "left_semi")
    sinks.append_log(known, path, ["prediction_id"])
    return sinks.append_log(known, path, ["prediction_id"])


_SILENCE = "2 days"


@query(
    "stream_live",
    f"""{SV}, l AS (SELECT *, row_number() OVER (PARTITION BY icao24 ORDER BY time_position DESC, event_id DESC) AS rn FROM sv)
    SELECT icao24, event_id, time_position, latitude, longitude,
    CASE WHEN time_position + INTERVAL {_SILENCE} <= {_CLOSED} THEN 'silent' ELSE 'live' END AS status FROM l WHERE rn = 1""",
)
def stream_live(spark, folder):
    """Latest position of every aircraft, and whether it has fallen silent."""
    columns = ["icao24", "event_id", "time_position", "latitude", "longitude"]
    return live.live_positions(_vectors(spark, folder).select(*columns), scratch_path(spark, "live"), _SILENCE, DELAY)


def _late_changes(spark, folder):
    """The orders as changes of their customers, in three deliveries that each have changes from all times."""
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")
    path = scratch_path(spark, "late-changes")
    for part in range(3):
        orders.where(F.pmod(F.xxhash64("o_orderkey"), F.lit(3)) == part).write.mode("append").parquet(path)
    return path


def _applied(spark, folder, apply):
    path, root = _late_changes(spark, folder), scratch_path(spark, "applied")
    stream = run.file_stream(spark, path, files_per_batch=1)
    return apply(stream, root, "o_custkey", "o_orderkey", F.expr("o_orderstatus = 'P'"), folders=8)


@query("stream_scd1", ORACLES["cdc_scd1"])
def stream_scd1(spark, folder):
    """Newest state of each customer from changes that come late and out of order."""
    return _applied(spark, folder, history.current_state)


@query("stream_scd2", ORACLES["cdc_scd2"])
def stream_scd2(spark, folder):
    """History of each customer from changes that come late and out of order."""
    return _applied(spark, folder, history.state_history)


@query(
    "stream_schema_evolution",
    """SELECT event_id, user_id, CASE WHEN event_id % 3 = 2 AND event_id % 5 = 0 THEN NULL ELSE value END AS value, event_type,
    CASE WHEN event_id % 3 > 0 THEN event_id % 7 = 0 END AS flagged,
    CASE WHEN event_id % 3 = 2 THEN concat('n', event_id) END AS note,
    CASE WHEN event_id % 3 = 2 AND event_id % 5 = 0 THEN concat('{"value":"bad ', event_id, '"}') END AS rescued
    FROM events""",
)
def stream_schema_evolution(spark, folder):
    """Three deliveries of JSON lines: the second brings a column, the third another one and values of another type."""
    events = table(spark, folder, "events")
    names = [F.col(c) for c in ("event_id", "user_id", "value", "event_type")]
    flagged, note = (F.col("event_id") % 7 == 0).alias("flagged"), F.concat(F.lit("n"), "event_id").alias("note")
    bad = F.concat(F.lit("bad "), "event_id")
    spoilt = [*names[:2], bad.alias("value"), names[3]]
    third, fifth = F.col("event_id") % 3, F.col("event_id") % 5
    deliveries = [
        [(third == 0, names)],
        [(third == 1, [*names, flagged])],
        [((third == 2) & (fifth != 0), [*names, flagged, note]), ((third == 2) & (fifth == 0), [*spoilt, flagged, note])],
    ]
    landing, evolving = scratch_path(spark, "landing"), ingest.EvolvingTable(spark, scratch_path(spark, "evolving"))
    for delivery in deliveries:
        for rows, columns in delivery:
            events.where(rows).select(F.to_json(F.struct(*columns)).alias("value")).write.mode("append").text(landing)
        evolving.ingest(landing)
    return evolving.read()
