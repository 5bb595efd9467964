"""Feature tables, lookups, as-of joins, samples and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyweave.functions.labels import PHASES, flight_phase
from skyweave.operators import features, sampling
from skyweave.operators.sequence import as_of, plan_slices
from skyweave.queries.base import CURATED, LABELLED, PHASE, RULE_CLASS, SV, curated, labelled, query
from skyweave.queries.sources import prediction_log, rounded_features
from skyweave.sources.telemetry import state_vectors, table

_ENTITY = """SELECT icao24, avg(velocity) AS avg_velocity, max(baro_altitude) AS max_baro_altitude,
    min(baro_altitude) AS min_baro_altitude, avg(geo_altitude) AS avg_geo_altitude,
    CAST(count(*) AS DOUBLE) AS num_state_vectors FROM cur GROUP BY icao24"""


@query("entity_features", f"{CURATED} SELECT * REPLACE (round(avg_velocity, 6) AS avg_velocity, round(avg_geo_altitude, 6) AS avg_geo_altitude) FROM ({_ENTITY})")
def entity_features(spark, folder):
    return rounded_features(features.entity_features(curated(spark, folder)))


@query(
    "feature_lookup",
    f"""{CURATED}, f AS ({_ENTITY}) SELECT event_id, icao24, round(avg_velocity, 6) AS avg_velocity,
    max_baro_altitude, num_state_vectors FROM sv LEFT JOIN f USING (icao24)""",
)
def feature_lookup(spark, folder):
    rows = state_vectors(spark, folder).select("event_id", "icao24")
    table_ = features.entity_features(curated(spark, folder))
    found = features.lookup(
        rows, table_, "icao24", ["avg_velocity", "max_baro_altitude", "num_state_vectors"], row_id="event_id"
    )
    return found.withColumn("avg_velocity", F.round("avg_velocity", 6))


@query(
    "feature_lookup_orders",
    """SELECT o_orderkey, o_custkey, c_mktsegment, c_acctbal FROM orders
    LEFT JOIN customer ON o_custkey = c_custkey""",
)
def feature_lookup_orders(spark, folder):
    customers = table(spark, folder, "customer").withColumnRenamed("c_custkey", "o_custkey")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return features.lookup(orders, customers, "o_custkey", ["c_mktsegment", "c_acctbal"])


_ASOF = f"""{CURATED}, v AS (SELECT icao24, CAST(CAST(time_position AS DATE) + 1 AS TIMESTAMP) AS known_at,
    avg(velocity) AS avg_velocity, max(baro_altitude) AS max_baro_altitude, CAST(count(*) AS DOUBLE) AS num_state_vectors
    FROM cur GROUP BY 1, 2)
    SELECT event_id, round(avg_velocity, 6) AS avg_velocity, max_baro_altitude, num_state_vectors, known_at
    FROM sv ASOF LEFT JOIN v ON sv.icao24 = v.icao24 AND sv.time_position > v.known_at"""


def _as_of(spark, folder, target_rows=None):
    rows = state_vectors(spark, folder).select("event_id", "icao24", "time_position")
    # A day's features are known from the following midnight on.
    day = F.to_date("time_position").alias("day")
    versions = features.entity_features(curated(spark, folder), day).withColumn(
        "known_at", F.date_add("day", 1).cast("timestamp_ntz")
    )
    names = ["avg_velocity", "max_baro_altitude", "num_state_vectors", "known_at"]
    # A key has at most one version a day, so cutting by the rows alone is even enough.
    slices = plan_slices(rows, "time_position", "event_id", target_rows)
    joined = as_of(rows, versions, ["icao24"], "time_position", "known_at", names, "event_id", slices=slices)
    return joined.select("event_id", F.round("avg_velocity", 6).alias("avg_velocity"), *names[1:])


@query("asof_features", _ASOF)
def asof_features(spark, folder):
    return _as_of(spark, folder)


@query("asof_features_sliced", _ASOF)
def asof_features_sliced(spark, folder):
    return _as_of(spark, folder, 1_000)


# Feedback comes from a share of the log's readers; some of it points at predictions never logged.
_LOG = f"log AS (SELECT event_id AS id, {RULE_CLASS} AS predicted_phase, {PHASE} AS flight_phase FROM sv WHERE velocity IS NOT NULL)"
_FEEDBACK = f"""fb AS (SELECT event_id AS feedback_id, event_id AS prediction_id, {PHASE} AS correct_phase,
    ({PHASE}) = ({RULE_CLASS}) AS is_correct FROM sv WHERE vertical_rate IS NOT NULL)"""


def _feedback(spark, folder):
    from skyweave.queries.sources import rule_class

    return (
        state_vectors(spark, folder)
        .where(F.col("vertical_rate").isNotNull())
        .select(
            F.col("event_id").alias("feedback_id"),
            F.col("event_id").alias("prediction_id"),
            flight_phase().alias("correct_phase"),
            (flight_phase() == rule_class()).alias("is_correct"),
        )
    )


@query(
    "fk_orphans",
    f"""{SV}, {_LOG}, {_FEEDBACK} SELECT feedback_id, prediction_id FROM fb
    WHERE NOT EXISTS (SELECT 1 FROM log WHERE log.id = fb.prediction_id)""",
)
def fk_orphans(spark, folder):
    log = prediction_log(state_vectors(spark, folder)).select(F.col("event_id").alias("prediction_id"))
    return _feedback(spark, folder).join(log, "prediction_id", "left_anti").select("feedback_id", "prediction_id")


@query(
    "feedback_accuracy",
    f"""{SV}, {_LOG}, {_FEEDBACK} SELECT predicted_phase, count(*) AS n_feedback,
    count(*) FILTER (WHERE is_correct) AS n_correct,
    round(avg(CAST(is_correct AS INT)), 6) AS accuracy FROM fb JOIN log ON log.id = fb.prediction_id GROUP BY 1""",
)
def feedback_accuracy(spark, folder):
    log = prediction_log(state_vectors(spark, folder)).select(
        F.col("event_id").alias("prediction_id"), "predicted_phase"
    )
    return (
        _feedback(spark, folder)
        .join(log, "prediction_id")
        .groupBy("predicted_phase")
        .agg(
            F.count(F.lit(1)).alias("n_feedback"),
            F.count_if("is_correct").alias("n_correct"),
            F.round(F.avg(F.col("is_correct").cast("int")), 6).alias("accuracy"),
        )
    )


def _bucket_sql(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 8))::BIGINT"


_CLASS_BUCKET = _bucket_sql("concat(flight_phase, '|', CAST(event_id AS VARCHAR), '|42')")


@query(
    "stratified_sample",
    f"""{LABELLED} SELECT event_id, flight_phase FROM lab
    WHERE {_CLASS_BUCKET} < least(1.0, 5000.0 / (SELECT count(*) FROM lab)) * 4294967296""",
)
def stratified_sample(spark, folder):
    df = labelled(spark, folder).select("event_id", "flight_phase")
    return sampling.stratified_sample(df, "flight_phase", 5000, 42)


@query("stratified_native")
def stratified_native(spark, folder):
    df = labelled(spark, folder).select("event_id", "flight_phase")
    return sampling.stratified_native(df, "flight_phase", PHASES, 5000, 42)


@query(
    "uniform_sample",
    f"""{SV} SELECT event_id, icao24 FROM sv
    WHERE {_bucket_sql("concat(CAST(event_id AS VARCHAR), '|99')")} <
    least(1.0, 5000.0 / (SELECT count(*) FROM sv)) * 4294967296""",
)
def uniform_sample(spark, folder):
    return sampling.uniform_sample(state_vectors(spark, folder).select("event_id", "icao24"), 5000, 99)


@query(
    "stratified_split",
    f"""{CURATED} SELECT event_id, flight_phase,
    CASE WHEN {_CLASS_BUCKET} % 100 < 80 THEN 'train' ELSE 'test' END AS part FROM cur""",
)
def stratified_split(spark, folder):
    return sampling.split(curated(spark, folder).select("event_id", "flight_phase"), "flight_phase")


@query(
    "training_set",
    f"""{CURATED}, f AS ({_ENTITY}), s AS (SELECT * FROM cur WHERE {_CLASS_BUCKET} <
    least(1.0, 200000.0 / (SELECT count(*) FROM cur)) * 4294967296)
    SELECT event_id, baro_altitude, geo_altitude, velocity, true_track, round(avg_velocity, 6) AS avg_velocity,
    max_baro_altitude, min_baro_altitude, round(avg_geo_altitude, 6) AS avg_geo_altitude, num_state_vectors,
    flight_phase FROM s JOIN f USING (icao24) WHERE avg_velocity IS NOT NULL AND max_baro_altitude IS NOT NULL""",
)
def training_set(spark, folder):
    rows = curated(spark, folder)
    sampled = sampling.stratified_sample(rows, "flight_phase", 200_000, 42)
    made = features.training_set(
        sampled,
        features.entity_features(rows),
        "icao24",
        features.AIRCRAFT_FEATURES,
        features.ROW_FEATURES,
        "flight_phase",
        keep=("event_id",),
    )
    return rounded_features(made)
