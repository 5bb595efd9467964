from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyweave.llm.langid import language
from skyweave.llm.quality import HOST_LIMITS, judged, measured
from skyweave.llm.queries.registry import query, table
from skyweave.llm.toxicity import toxicity
from skyweave.llm.workspace import Workspace


@query("op5_quality_rules")
def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    workspace = Workspace(spark, "quality")
    rows = measured(table(spark, folder, "documents"), "source", ["doc_id"], workspace)
    return judged(rows, HOST_LIMITS, workspace).select(
        F.col("in_doc_id").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "removed_words",
    )


def _fold(count: int):
    return F.crc32(F.col("doc_id").cast("string")) % count


@query("op6_language_id")
def language_id(spark: SparkSession, folder: str) -> DataFrame:
    held_out = F.coalesce(_fold(4) == 2, F.lit(False))
    found = language(table(spark, folder, "documents"), ~held_out)
    return found.withColumn("held_out", held_out).select("doc_id", "held_out", "lang_pred", "score", "margin", "accepted")


@query("op9_toxicity")
def toxic_documents(spark: SparkSession, folder: str) -> DataFrame:
    found = toxicity(
        table(spark, folder, "documents"), table(spark, folder, "labels"), _fold(5), Workspace(spark, "toxicity", frees=True)
    )
    return found.select("doc_id", "held_out", "score", "predicted")
