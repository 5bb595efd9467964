"""Label quality, candidates and model tables, with a rule classifier as the prediction."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyweave.functions.labels import PHASES
from skyweave.operators import evaluate
from skyweave.plans.learning import ModelTable
from skyweave.queries.base import CURATED, JUDGED, curated, query
from skyweave.queries.sources import rule_class
from skyweave.session import scratch_path


def _judged(spark, folder):
    return curated(spark, folder).withColumn("flight_phase_pred", rule_class())


@query(
    "class_weights",
    f"""{CURATED}, c AS (SELECT flight_phase, count(*) AS n_rows FROM cur GROUP BY 1)
    SELECT flight_phase, n_rows, round((SELECT sum(n_rows) FROM c) / ((SELECT count(*) FROM c) * n_rows), 8) AS class_weight
    FROM c""",
)
def class_weights(spark, folder):
    weights = evaluate.class_weights(curated(spark, folder), "flight_phase")
    return weights.withColumn("class_weight", F.round("class_weight", 8))


@query(
    "confusion_matrix",
    f"""{JUDGED} SELECT flight_phase AS actual, """
    + ", ".join(f"count(*) FILTER (WHERE flight_phase_pred = '{p}') AS pred_{p}" for p in sorted(PHASES))
    + " FROM judged GROUP BY 1",
)
def confusion_matrix(spark, folder):
    return evaluate.confusion_matrix(_judged(spark, folder), "flight_phase", "flight_phase_pred", PHASES)


_PER_LABEL = """, l AS (SELECT label, (SELECT count(*) FROM judged WHERE flight_phase = label) AS support,
    (SELECT count(*) FROM judged WHERE flight_phase_pred = label) AS claimed,
    (SELECT count(*) FROM judged WHERE flight_phase = label AND flight_phase_pred = label) AS hits
    FROM (SELECT flight_phase AS label FROM judged UNION SELECT flight_phase_pred FROM judged)),
    m AS (SELECT label, support, hits, CASE WHEN claimed > 0 THEN hits / claimed ELSE 0.0 END AS precision,
    CASE WHEN support > 0 THEN hits / support ELSE 0.0 END AS recall,
    CASE WHEN support + claimed > 0 THEN 2.0 * hits / (support + claimed) ELSE 0.0 END AS f1 FROM l)"""

_REPORT = """ SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support
    FROM m WHERE support > 0
    UNION ALL SELECT 'accuracy', round(sum(hits) / sum(support), 6), round(sum(hits) / sum(support), 6),
    round(sum(hits) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM m WHERE support > 0
    UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
    CAST(sum(support) AS BIGINT) FROM m WHERE support > 0
    UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
    round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
    CAST(sum(support) AS BIGINT) FROM m WHERE support > 0"""


@query("classification_report", f"{JUDGED}{_PER_LABEL}{_REPORT}")
def classification_report(spark, folder):
    return evaluate.classification_report(_judged(spark, folder), "flight_phase", "flight_phase_pred")


@query("macro_f1", f"{JUDGED}{_PER_LABEL} SELECT round(avg(f1), 6) AS macro_f1 FROM m")
def macro_f1(spark, folder):
    return evaluate.macro_f1(_judged(spark, folder), "flight_phase", "flight_phase_pred")


_HELD = "('0x' || substr(md5(concat(flight_phase, '|', CAST(event_id AS VARCHAR), '|42')), 1, 8))::BIGINT % 100 >= 80"


@query(
    "eval_predictions",
    JUDGED.replace("FROM cur)", f"FROM cur WHERE {_HELD})") + _PER_LABEL + _REPORT,
)
def eval_predictions(spark, folder):
    from skyweave.operators.sampling import split

    held_out = split(_judged(spark, folder), "flight_phase").where(F.col("part") == "test")
    return evaluate.classification_report(held_out, "flight_phase", "flight_phase_pred")


# Three rule classifiers that differ in where cruise begins.
_CUTS = (7000, 8000, 9000)


def _candidates(spark, folder):
    """Macro-F1 of each cut. All candidates are judged in one scan."""
    altitude = F.col("baro_altitude")
    entries = [
        F.struct(
            F.lit(f"cut_{cut}").alias("candidate"),
            F.when(altitude < 300, "Ground").when(altitude >= cut, "Cruise").otherwise("Climb").alias("pred"),
        )
        for cut in _CUTS
    ]
    pairs = (
        curated(spark, folder)
        .select("flight_phase", F.inline(F.array(*entries)))
        .groupBy("candidate", "flight_phase", "pred")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    sides = pairs.select(
        "candidate",
        F.inline(
            F.array(
                F.struct(F.col("flight_phase").alias("label"), "n"),
                F.struct(F.col("pred").alias("label"), "n"),
            )
        ),
        F.when(F.col("flight_phase") == F.col("pred"), F.col("n")).otherwise(0).alias("hits"),
    )
    per_label = sides.groupBy("candidate", "label").agg((F.sum("hits") / F.sum("n")).alias("f1"))
    return per_label.groupBy("candidate").agg(F.round(F.avg("f1"), 6).alias("macro_f1"))


def _candidate_sql(cut: int) -> str:
    pred = f"CASE WHEN baro_altitude < 300 THEN 'Ground' WHEN baro_altitude >= {cut} THEN 'Cruise' ELSE 'Climb' END"
    return f"""SELECT 'cut_{cut}' AS candidate, round(avg(f1), 6) AS macro_f1 FROM (
    SELECT label, 2.0 * count(*) FILTER (WHERE a = label AND p = label) /
    (count(*) FILTER (WHERE a = label) + count(*) FILTER (WHERE p = label)) AS f1
    FROM (SELECT flight_phase AS a, {pred} AS p FROM cur), (SELECT DISTINCT flight_phase AS label FROM cur) GROUP BY 1)"""


_SCORES = ", scores AS (" + " UNION ALL ".join(_candidate_sql(c) for c in _CUTS) + ")"
_BEST = "SELECT candidate, macro_f1 FROM scores ORDER BY macro_f1 DESC, candidate LIMIT 1"


@query("best_candidate", f"{CURATED}{_SCORES} {_BEST}")
def best_candidate(spark, folder):
    return evaluate.best_candidate(_candidates(spark, folder))


def _versions(spark, folder):
    version = F.substring("candidate", 5, 10).cast("bigint")
    return _candidates(spark, folder).select(
        F.lit("flight_phase_model").alias("model"), version.alias("version"), "candidate", "macro_f1"
    )


@query(
    "model_alias",
    f"""{CURATED}{_SCORES}, best AS ({_BEST}), worst AS
    (SELECT candidate, macro_f1 FROM scores ORDER BY macro_f1, candidate DESC LIMIT 1)
    SELECT 'flight_phase_model' AS model, 'prod' AS alias, CAST(substr(candidate, 5) AS BIGINT) AS version, candidate,
    macro_f1 FROM best UNION ALL SELECT 'flight_phase_model', 'previous', CAST(substr(candidate, 5) AS BIGINT),
    candidate, macro_f1 FROM worst""",
)
def model_alias(spark, folder):
    registry = ModelTable(spark, scratch_path(spark, "models"))
    registry.register(_versions(spark, folder))
    versions = spark.read.parquet(f"{registry.root}/versions")
    best = evaluate.best_candidate(versions)
    worst = versions.orderBy("macro_f1", F.desc("candidate")).limit(1)
    registry.point("prod", worst, 1)
    registry.point("prod", best, 2)
    registry.point("previous", worst, 2)
    # These are rules, not fitted models, so there is no folder to load them from.
    return registry.resolve().drop("path")


@query(
    "run_metrics",
    f"""{CURATED}{_SCORES} SELECT candidate AS run, 'metric' AS kind, 'macro_f1' AS name,
    CAST(macro_f1 AS VARCHAR) AS value FROM scores UNION ALL SELECT candidate, 'param', 'cut', substr(candidate, 5) FROM scores""",
)
def run_metrics(spark, folder):
    registry = ModelTable(spark, scratch_path(spark, "runs"))
    records = F.inline(
        F.array(
            F.struct(F.lit("metric").alias("kind"), F.lit("macro_f1").alias("name"), F.col("macro_f1").cast("string").alias("value")),
            F.struct(F.lit("param").alias("kind"), F.lit("cut").alias("name"), F.substring("candidate", 5, 10).alias("value")),
        )
    )
    registry.log_runs(_candidates(spark, folder).select(F.col("candidate").alias("run"), records))
    return registry.runs()
