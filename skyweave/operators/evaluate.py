"""Classification quality from a table of actual and predicted labels.

Only the label-pair counts leave the first aggregate; everything else works on that handful of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pair_counts(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def confusion_matrix(df: DataFrame, actual: str, predicted: str, labels) -> DataFrame:
    """One row per actual label, one column per predicted label, zero where a pair never occurs."""
    labels = sorted(labels)
    return (
        df.where(F.col(actual).isin(labels))
        .groupBy(F.col(actual).alias("actual"))
        .agg(*[F.count_if(F.col(predicted) == label).alias(f"pred_{label}") for label in labels])
        .orderBy("actual")
    )


def per_label(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support over the union of actual and predicted labels.

    A ratio with an empty denominator is 0.
    """
    pairs = pair_counts(df, actual, predicted)
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)
    sides = F.inline(
        F.array(
            F.struct(F.col("actual").alias("label"), hit.alias("hits"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("claimed")),
            F.struct(F.col("predicted").alias("label"), F.lit(0).cast("bigint").alias("hits"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("claimed")),
        )
    )
    totals = pairs.select(sides).groupBy("label").agg(
        F.sum("hits").alias("hits"), F.sum("support").alias("support"), F.sum("claimed").alias("claimed")
    )

    def ratio(part, whole):
        return F.when(whole > 0, part / whole).otherwise(0.0)

    hits = F.col("hits")
    return totals.select(
        "label",
        "support",
        ratio(hits, F.col("claimed")).alias("precision"),
        ratio(hits, F.col("support")).alias("recall"),
        ratio(2 * hits, F.col("support") + F.col("claimed")).alias("f1"),
        "hits",
    )


def classification_report(df: DataFrame, actual: str, predicted: str, digits: int = 6) -> DataFrame:
    """Per-label rows (labels that occur as actual) plus accuracy, macro and weighted averages."""
    seen = per_label(df, actual, predicted).where(F.col("support") > 0)
    rounded = [F.round(c, digits).alias(c) for c in ("precision", "recall", "f1")]
    rows = seen.select("label", *rounded, "support")
    weight = F.sum("support")

    def weighted(column):
        return F.sum(F.col(column) * F.col("support")) / weight

    summary = seen.agg(
        weight.alias("w"),
        (F.sum("hits") / weight).alias("accuracy"),
        *[F.avg(c).alias(f"m_{c}") for c in ("precision", "recall", "f1")],
        *[weighted(c).alias(f"w_{c}") for c in ("precision", "recall", "f1")],
    )

    def line(label, *values):
        names = ("precision", "recall", "f1")
        return F.struct(
            F.lit(label).alias("label"),
            *[F.round(v, digits).alias(n) for n, v in zip(names, values)],
            F.col("w").alias("support"),
        )

    accuracy = F.col("accuracy")
    averages = summary.select(
        F.inline(
            F.array(
                line("accuracy", accuracy, accuracy, accuracy),
                line("macro avg", *[F.col(f"m_{c}") for c in ("precision", "recall", "f1")]),
                line("weighted avg", *[F.col(f"w_{c}") for c in ("precision", "recall", "f1")]),
            )
        )
    )
    return rows.unionByName(averages)


def macro_f1(df: DataFrame, actual: str, predicted: str, digits: int = 6) -> DataFrame:
    """Unweighted mean F1 over the union of actual and predicted labels."""
    return per_label(df, actual, predicted).agg(F.round(F.avg("f1"), digits).alias("macro_f1"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight of each class: rows / (classes * rows of the class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_rows"))
    whole = counts.agg(F.struct(F.sum("n_rows").alias("rows"), F.count(F.lit(1)).alias("classes"))).scalar()
    return counts.withColumn("class_weight", whole["rows"] / (whole["classes"] * F.col("n_rows")))


def best_candidate(metrics: DataFrame, score: str = "macro_f1", name: str = "candidate") -> DataFrame:
    """The candidate with the highest score, ties to the first name."""
    return metrics.orderBy(F.desc(score), F.asc(name)).limit(1)
