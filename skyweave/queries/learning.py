"""Fitted models over the curated rows.

All rows are split by hash first. Models are fitted on all rows of the training part; reports and scores cover all others. What a model
predicts has no SQL form: for the scoring queries SQL checks every other column and that each row has one of the labels, and the
``*_quality`` queries check that the predictions are better than the commonest label. Within an application a
candidate is fitted once for each input and its settings; later queries load it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyweave.functions.labels import PHASES
from skyweave.operators import evaluate, features, sampling
from skyweave.operators.features import AIRCRAFT_FEATURES, ROW_FEATURES
from skyweave.plans import boosting, learning
from skyweave.queries.base import CURATED, curated, query
from skyweave.session import made_once, materialise, scratch_path
from skyweave.sources.sinks import keyed_table, overwrite

LABEL = learning.LABEL
MODEL = "flight_phase_model"


def parts(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Rows to fit on and held-out rows: all curated rows split by hash. The whole training part, unless ``TRAIN_ROWS`` has a bound."""

    def make(path: str) -> None:
        rows = curated(spark, folder).select("event_id", "icao24", *ROW_FEATURES, LABEL)
        sampling.split(rows, LABEL).write.parquet(f"{path}/marked")
        if learning.TRAIN_ROWS is not None:
            train = spark.read.parquet(f"{path}/marked").where(F.col("part") == "train")
            sample = sampling.stratified_sample(train, LABEL, learning.TRAIN_ROWS, learning.TRAIN_SEED)
            sample.write.parquet(f"{path}/sample")

    path = made_once(spark, "split-rows", (folder, learning.TRAIN_ROWS), make)
    marked = spark.read.parquet(f"{path}/marked")
    if learning.TRAIN_ROWS is None:
        train = marked.where((F.col("part") == "train") & F.col(LABEL).isNotNull())
    else:
        train = spark.read.parquet(f"{path}/sample")
    return train, marked.where(F.col("part") == "test")


def _settings(folder: str, *more) -> tuple:
    return folder, learning.TRAIN_ROWS, learning.FOREST_TREES, learning.FOREST_DEPTH, learning.BOOSTING_ROUNDS, *more


def fitted(spark: SparkSession, folder: str, candidate: str) -> tuple[PipelineModel, DataFrame]:
    """The fitted model of a candidate and the held-out rows."""
    train, held_out = parts(spark, folder)

    def make(path: str) -> None:
        model = learning.fit(candidate, train, ROW_FEATURES, rounds=learning.BOOSTING_ROUNDS)
        model.write().overwrite().save(path)

    path = made_once(spark, "fitted", _settings(folder, candidate), make)
    return PipelineModel.load(path), held_out


def registered(spark: SparkSession, folder: str, candidates=(learning.LOGISTIC, learning.FOREST)) -> learning.ModelTable:
    """A registry of fitted candidates, judged on all held-out rows, with ``prod`` at the best."""

    def make(path: str) -> None:
        fits = {c: fitted(spark, folder, c)[0] for c in candidates}
        held_out = parts(spark, folder)[1]
        scores = materialise(learning.compare({c: learning.score(m, held_out) for c, m in fits.items()}, LABEL), "scores")
        registry = learning.ModelTable(spark, path)
        registry.store(MODEL, fits, scores)
        learning.promote(registry, MODEL, 1)

    return learning.ModelTable(spark, made_once(spark, "registry", _settings(folder, *candidates), make))


def _report(spark, folder, candidate):
    model, held_out = fitted(spark, folder, candidate)
    return evaluate.classification_report(learning.score(model, held_out), LABEL, f"{LABEL}_pred")


@query("ml_logistic")
def ml_logistic(spark, folder):
    return _report(spark, folder, learning.LOGISTIC)


@query("ml_forest")
def ml_forest(spark, folder):
    return _report(spark, folder, learning.FOREST)


@query("ml_boosting")
def ml_boosting(spark, folder):
    return _report(spark, folder, learning.BOOSTING)


CANDIDATES = (learning.LOGISTIC, learning.FOREST, learning.BOOSTING)


@query("ml_compare")
def ml_compare(spark, folder):
    predictions = {}
    for candidate in CANDIDATES:
        model, held_out = fitted(spark, folder, candidate)
        predictions[candidate] = learning.score(model, held_out)
    scores = materialise(learning.compare(predictions, LABEL), "candidate-scores")
    best = evaluate.best_candidate(scores).select("candidate", F.lit(True).alias("is_best"))
    return scores.join(best, "candidate", "left").withColumn("is_best", F.coalesce("is_best", F.lit(False)))


def _kept(scored: DataFrame, *more: str) -> DataFrame:
    """Actual and predicted labels written once, for several branches read them and scoring costs far more than reading."""
    return materialise(scored.select(LABEL, f"{LABEL}_pred", *more), "judged")


def _judged(scored: DataFrame, name: str) -> DataFrame:
    """Per label that occurs: its rows, whether every row has got a label, and whether the labels are better, by the share that is right
    and by macro-F1, than always the commonest. ``scored`` is read more than once."""
    counts = scored.groupBy(LABEL).agg(F.count(F.lit(1)).alias("support"))
    whole = counts.agg(F.max("support").alias("most"), F.count(F.lit(1)).alias("classes"), F.sum("support").alias("all_rows"))
    report = evaluate.classification_report(scored, LABEL, f"{LABEL}_pred")
    macro = report.where("label = 'macro avg'").select("f1")
    confusion = scored.where(F.col(f"{LABEL}_pred").isin(*PHASES)).agg(F.count(F.lit(1)).alias("labelled"))
    share = F.col("most") / F.col("all_rows")
    single = 2 * share / (1 + share) / F.col("classes")
    facts = whole.join(macro).join(confusion).select(
        (F.col("labelled") == F.col("all_rows")).alias("all_labelled"), (F.col("f1") > 1.2 * single).alias("beats_commonest")
    )
    return counts.join(F.broadcast(facts)).select(F.lit(name).alias("scored_by"), LABEL, "support", "all_labelled", "beats_commonest")


@query(
    "ml_quality",
    f"""{CURATED}, test AS (
      SELECT flight_phase FROM cur
      WHERE ('0x' || substr(md5(concat(flight_phase, '|', CAST(event_id AS VARCHAR), '|42')), 1, 8))::BIGINT % 100 >= 80
    ) SELECT c AS scored_by, flight_phase, count(*) AS support, true AS all_labelled, true AS beats_commonest
    FROM test, (VALUES ('logistic_regression'), ('random_forest'), ('hist_gradient_boosting')) v(c) GROUP BY ALL""",
)
def ml_quality(spark, folder):
    """Every candidate on the held-out rows: supports of the labels, and whether the model is worth anything."""
    tables = []
    for candidate in CANDIDATES:
        model, held_out = fitted(spark, folder, candidate)
        tables.append(_judged(_kept(learning.score(model, held_out)), candidate))
    return reduce(DataFrame.unionByName, tables)


_BINS = 16


@query(
    "boosting_bins",
    f"""{CURATED}, v AS (UNPIVOT (SELECT {", ".join(ROW_FEATURES)} FROM cur) ON COLUMNS(*) INTO NAME feature VALUE value),
    l AS (SELECT feature, list_sort(list(value)) AS s, count(*) - 1 AS last FROM v GROUP BY feature),
    e AS (SELECT feature, list_distinct(list_transform(range(1, {_BINS}), lambda i: s[1 + i * last // {_BINS}]
      + (s[1 + (i * last + {_BINS} - 1) // {_BINS}] - s[1 + i * last // {_BINS}]) * (i * last % {_BINS} / {_BINS}.0))) AS cuts FROM l)
    SELECT v.feature, CAST(len(list_filter(cuts, lambda x: x <= value)) AS INTEGER) AS bin, count(*) AS n_rows
    FROM v JOIN e USING (feature) GROUP BY ALL""",
)
def boosting_bins(spark, folder):
    """Rows per bin of the features as boosting bins them, with fewer bins."""
    rows = curated(spark, folder).select(*ROW_FEATURES)
    placed = boosting.binned(rows, boosting.bin_edges(rows, ROW_FEATURES, _BINS))
    long = placed.select(*[F.col(f"{f}_bin").alias(f) for f in ROW_FEATURES]).unpivot([], ROW_FEATURES, "feature", "bin")
    return long.groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("n_rows"))


_LABELS = ", ".join(f"'{p}'" for p in sorted(PHASES))
_BUCKET = "('0x' || substr(md5(concat(flight_phase, '|', CAST(event_id AS VARCHAR), '|42')), 1, 8))::BIGINT"


def _known(predicted: str):
    return F.coalesce(F.col(predicted).isin(*PHASES), F.lit(False)).alias("has_label")


@query(
    "batch_score",
    f"""{CURATED} SELECT event_id, icao24, baro_altitude, geo_altitude, velocity, true_track,
    flight_phase AS flight_phase_actual, true AS has_label, true AS is_stamped FROM cur""",
)
def batch_score(spark, folder):
    model, _ = registered(spark, folder).load(MODEL, "prod")
    gold = learning.gold_predictions(model, curated(spark, folder), ["event_id", "icao24", *ROW_FEATURES])
    written = overwrite(gold, scratch_path(spark, "predictions"))
    return written.select(
        *written.columns[:-2], _known(f"{LABEL}_pred"), F.col("scored_at").isNotNull().alias("is_stamped")
    )


@query(
    "alias_move",
    """SELECT 'before' AS step, 'prod' AS alias, 'random_forest' AS candidate, true AS labels_differ UNION ALL
    SELECT 'after', 'prod', 'logistic_regression', true""",
)
def alias_move(spark, folder):
    """An alias decides what scores: after it has moved, another model labels the same rows."""
    candidates = (learning.FOREST, learning.LOGISTIC)
    registry = learning.ModelTable(spark, scratch_path(spark, "moved-registry"))
    scores = registered(spark, folder)._read("versions").select("candidate", "macro_f1")
    registry.store(MODEL, {c: fitted(spark, folder, c)[0] for c in candidates}, scores)
    versions = registry._read("versions")
    rows = materialise(curated(spark, folder).select("event_id", *ROW_FEATURES), "rows-to-score")
    steps, scored = [], {}
    for move, (step, candidate) in enumerate(zip(("before", "after"), candidates), start=1):
        registry.point("prod", versions.where(F.col("candidate") == candidate), move)
        model, found = registry.load(MODEL, "prod")
        steps.append((step, "prod", found))
        scored[step] = learning.score(model, rows).select("event_id", F.col(f"{LABEL}_pred").alias(step))
    differ = scored["before"].join(scored["after"], "event_id").agg(F.max(F.expr("before <> after")).alias("labels_differ"))
    return spark.createDataFrame(steps, "step string, alias string, candidate string").join(differ)


@query(
    "score_with_lookup",
    f"""{CURATED} SELECT event_id, icao24, flight_phase, true AS has_label FROM cur WHERE {_BUCKET} % 100 >= 80
    UNION ALL SELECT event_id, 'ffffff', flight_phase, true FROM cur WHERE {_BUCKET} % 100 >= 80""",
)
def score_with_lookup(spark, folder):
    return _scored_by_lookup(spark, folder).select("event_id", "icao24", LABEL, _known(f"{LABEL}_pred"))


def _scored_by_lookup(spark: SparkSession, folder: str) -> DataFrame:
    def make(root: str) -> None:
        table = keyed_table(features.entity_features(curated(spark, folder)), f"{root}/features", ["icao24"])
        train, _ = parts(spark, folder)
        made = features.training_set(train, table, "icao24", AIRCRAFT_FEATURES, ROW_FEATURES, LABEL)
        model = learning.fit(learning.FOREST, materialise(made, "lookup-training"), ROW_FEATURES + AIRCRAFT_FEATURES)
        learning.save_with_lookup(
            model, f"{root}/model", table=f"{root}/features", key="icao24", names=AIRCRAFT_FEATURES
        )

    root = made_once(spark, "lookup-model", _settings(folder), make)
    _, held_out = parts(spark, folder)
    # Every held-out row a second time, as of an aircraft nobody knows.
    strangers = held_out.withColumn("icao24", F.lit("ffffff"))
    return learning.score_with_lookup(spark, f"{root}/model", held_out.unionByName(strangers), "event_id")


@query(
    "scoring_quality",
    f"""{CURATED}, test AS (SELECT flight_phase FROM cur WHERE {_BUCKET} % 100 >= 80)
    SELECT 'alias' AS scored_by, flight_phase, count(*) AS support, true AS all_labelled, true AS beats_commonest
    FROM cur GROUP BY ALL UNION ALL
    SELECT 'known keys', flight_phase, count(*), true, true FROM test GROUP BY ALL UNION ALL
    SELECT 'unknown keys', flight_phase, count(*), true, true FROM test GROUP BY ALL""",
)
def scoring_quality(spark, folder):
    """What an alias labels, and what a model with its lookup does for known and for unknown keys."""
    model, _ = registered(spark, folder).load(MODEL, "prod")
    by_alias = _kept(learning.score(model, curated(spark, folder).select("event_id", *ROW_FEATURES, LABEL)))
    by_lookup = _kept(_scored_by_lookup(spark, folder), "icao24")
    stranger = F.col("icao24") == "ffffff"
    found = {"alias": by_alias, "known keys": by_lookup.where(~stranger), "unknown keys": by_lookup.where(stranger)}
    return reduce(DataFrame.unionByName, [_judged(scored, name) for name, scored in found.items()])
