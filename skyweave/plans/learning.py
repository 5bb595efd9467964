"""Distributed classification: candidates, comparison, versions, scoring.

Models are fitted on all rows of the training part, unless ``TRAIN_ROWS`` bounds them; evaluation and scoring cover all other rows.
Logistic regression fits and scores in the JVM, forests and boosted trees by Arrow batches; scoring never leaves DataFrames.
"""

from __future__ import annotations

import json

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import Imputer, IndexToString, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyweave.operators.evaluate import best_candidate, class_weights, macro_f1
from skyweave.operators.features import lookup
from skyweave.plans.boosting import Growth, fit_boosting
from skyweave.plans.forest import fit_forest
from skyweave.session import ensure_checkpoint_dir

# Names and settings of the candidates; the most rows a model is fitted on, None for all of them, and the seed of the
# sample a bound would take.
LOGISTIC, FOREST, BOOSTING = "logistic_regression", "random_forest", "hist_gradient_boosting"
FOREST_TREES, FOREST_DEPTH = 200, 16
BOOSTING_ROUNDS, BOOSTING_RATE = 200, 0.1
FOREST_SEED = 42
TRAIN_ROWS, TRAIN_SEED = None, 42

SETTINGS = {
    LOGISTIC: {"penalty": "l2", "class_weight": "balanced"},
    FOREST: {"trees": FOREST_TREES, "depth": FOREST_DEPTH, "class_weight": "balanced"},
    BOOSTING: {"rounds": BOOSTING_ROUNDS, "rate": BOOSTING_RATE, "class_weight": "balanced"},
}

LABEL = "flight_phase"
# Tree fitting starts many short jobs: partitions below the first size cost more than they save, and there are no more than ``PARTITIONS``
# (or cores) before they reach the second.
ROWS_PER_PARTITION, MOST_ROWS_PER_PARTITION, PARTITIONS = 20_000, 500_000, 32
# Tasks for each core when rows are scored.
SCORE_SPREAD = 2


def weighted(train: DataFrame, label: str = LABEL) -> DataFrame:
    """Attach the balanced class weight of each row."""
    return train.join(class_weights(train, label).select(label, "class_weight"), label)


def _spread(train: DataFrame, rows: int) -> DataFrame:
    """The rows dealt to partitions whose number suits tree fitting."""
    most = max(PARTITIONS, train.sparkSession.sparkContext.defaultParallelism, rows // MOST_ROWS_PER_PARTITION)
    return train.repartition(min(1 + rows // ROWS_PER_PARTITION, most))


def fit(
    candidate: str,
    train: DataFrame,
    features: list[str],
    label: str = LABEL,
    rounds: int = BOOSTING_ROUNDS,
) -> PipelineModel:
    """Fit one candidate. The result adds ``flight_phase_pred`` to any DataFrame with the features.

    A feature that is null or NaN when a row is scored counts as the median of the training rows, so that a row with
    an unknown key is judged by the features it has; boosted trees have a side for it at each split.
    """
    ensure_checkpoint_dir(train.sparkSession)
    indexer = StringIndexer(inputCol=label, outputCol="label_index", stringOrderType="alphabetAsc").fit(train)
    rows = train.count()
    spread = _spread(train, rows)
    prepared = indexer.transform(weighted(spread, label)).select(*features, "label_index", "class_weight").persist()
    names = IndexToString(inputCol="prediction", outputCol=f"{label}_pred", labels=indexer.labels)
    filled = [f"__{f}" for f in features]
    imputer = Imputer(strategy="median", inputCols=features, outputCols=filled)
    try:
        if candidate == BOOSTING:
            growth = Growth(rate=BOOSTING_RATE)
            trees = fit_boosting(prepared, features, "label_index", "class_weight", len(indexer.labels), rounds, growth)
            return PipelineModel([trees, names])
        if candidate == FOREST:
            medians = imputer.fit(prepared)
            whole = medians.transform(prepared)
            size = len(indexer.labels), FOREST_TREES, FOREST_DEPTH, FOREST_SEED
            return PipelineModel([medians, fit_forest(whole, filled, "label_index", "class_weight", *size), names])
        if candidate != LOGISTIC:
            raise ValueError(f"unknown candidate: {candidate}")
        # An L2 penalty of 1 against the summed loss is 1 / rows against Spark's mean loss.
        regression = LogisticRegression(
            featuresCol="scaled",
            labelCol="label_index",
            weightCol="class_weight",
            maxIter=1000,
            tol=1e-4,
            regParam=1.0 / max(rows, 1),
        )
        assembler = VectorAssembler(inputCols=filled, outputCol="features")
        scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True)
        return Pipeline(stages=[imputer, assembler, scaler, regression, names]).fit(prepared)
    finally:
        prepared.unpersist()


def score(model: PipelineModel, df: DataFrame, label: str = LABEL) -> DataFrame:
    """Add the predicted label to every row; works on batch and streaming input alike.

    Scoring a row costs far more than moving it, so stored rows are dealt to all cores, however few files they come from.
    """
    if not df.isStreaming:
        df = df.repartition(SCORE_SPREAD * df.sparkSession.sparkContext.defaultParallelism)
    return model.transform(df).select(*df.columns, f"{label}_pred")


def gold_predictions(
    model: PipelineModel, df: DataFrame, keep: list[str], label: str = LABEL
) -> DataFrame:
    """Scored rows in the shape of the predictions table."""
    return (
        score(model, df, label)
        .withColumnRenamed(label, f"{label}_actual")
        .withColumn("scored_at", F.current_timestamp())
        .select(*keep, f"{label}_actual", f"{label}_pred", "scored_at")
    )


def compare(predictions: dict[str, DataFrame], label: str = LABEL) -> DataFrame:
    """Macro-F1 of every candidate on its own predictions."""
    scores = [
        macro_f1(df, label, f"{label}_pred").select(F.lit(name).alias("candidate"), "macro_f1")
        for name, df in predictions.items()
    ]
    table = scores[0]
    for other in scores[1:]:
        table = table.unionByName(other)
    return table


class ModelTable:
    """Model versions, their movable aliases and run records as append-only tables.

    A version may have the folder its fitted model is in; ``load`` opens the one an alias points to.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def _append(self, table: str, df: DataFrame) -> None:
        df.write.mode("append").parquet(f"{self.root}/{table}")

    def _read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{table}")

    def register(self, models: DataFrame) -> None:
        """Add versions: columns model, version, candidate, macro_f1 and, for fitted models, path."""
        path = F.col("path") if "path" in models.columns else F.lit(None).cast("string").alias("path")
        self._append("versions", models.select("model", "version", "candidate", "macro_f1", path))

    def store(self, name: str, fits: dict[str, PipelineModel], scores: DataFrame) -> DataFrame:
        """Save fitted candidates as versions 1, 2, ... in the order of their names, with their scores and run records."""
        rows, records = [], []
        for number, candidate in enumerate(sorted(fits), start=1):
            path = f"{self.root}/models/{name}/{number}"
            fits[candidate].write().overwrite().save(path)
            rows.append((name, number, candidate, path))
            records += [(candidate, "param", k, str(v)) for k, v in SETTINGS[candidate].items()]
        versions = self.spark.createDataFrame(rows, "model string, version bigint, candidate string, path string")
        self.register(versions.join(scores, "candidate"))
        metrics = scores.select(
            F.col("candidate").alias("run"), F.lit("metric").alias("kind"), F.lit("macro_f1").alias("name"),
            F.col("macro_f1").cast("string").alias("value"),
        )
        self.log_runs(metrics)
        self.log_runs(self.spark.createDataFrame(records, "run string, kind string, name string, value string"))
        return self._read("versions").where(F.col("model") == name)

    def load(self, name: str, alias: str) -> tuple[PipelineModel, str]:
        """The fitted model an alias points to, and the name of its candidate."""
        found = self.resolve().where((F.col("model") == name) & (F.col("alias") == alias)).first()
        if found is None or found.path is None:
            raise LookupError(f"no fitted model {name}@{alias}")
        return PipelineModel.load(found.path), found.candidate

    def point(self, alias: str, targets: DataFrame, move: int) -> None:
        """Move an alias: columns model, version. The highest move wins."""
        self._append(
            "aliases",
            targets.select("model", "version", F.lit(alias).alias("alias"), F.lit(move).alias("move")),
        )

    def log_runs(self, runs: DataFrame) -> None:
        """Add run records: columns run, kind, name, value."""
        self._append("runs", runs.select("run", "kind", "name", "value"))

    def runs(self) -> DataFrame:
        return self._read("runs")

    def resolve(self) -> DataFrame:
        """The version every alias points to now."""
        current = self._read("aliases").groupBy("model", "alias").agg(
            F.max_by("version", "move").alias("version")
        )
        return current.join(self._read("versions"), ["model", "version"])


def promote(registry: ModelTable, name: str, move: int, alias: str = "prod") -> DataFrame:
    """Point an alias at the best version by macro-F1; a tie goes to the first candidate by name."""
    best = best_candidate(registry._read("versions").where(F.col("model") == name))
    registry.point(alias, best, move)
    return registry.resolve()


def save_with_lookup(
    model: PipelineModel, path: str, *, table: str, key: str, names: list[str]
) -> None:
    """Store a model together with the feature lookup it was trained with."""
    model.write().overwrite().save(f"{path}/model")
    spec = json.dumps({"table": table, "key": key, "names": names})
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([(spec,)], "spec string").coalesce(1).write.mode("overwrite").text(f"{path}/lookup")


def score_with_lookup(spark: SparkSession, path: str, df: DataFrame, row_id: str | None = None) -> DataFrame:
    """Load a stored model, add the features it asks for, and score.

    Unknown keys get null features, which the model replaces by its training medians when it scores. ``row_id`` lets
    the lookup spread the rows of a hot key.
    """
    spec = json.loads(spark.read.text(f"{path}/lookup").first().value)
    features = spark.read.parquet(spec["table"])
    joined = lookup(df, features, spec["key"], spec["names"], row_id=row_id)
    return score(PipelineModel.load(f"{path}/model"), joined)
