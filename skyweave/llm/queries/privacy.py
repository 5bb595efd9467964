from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyweave.llm.pii import KINDS, personal_data, spans_text
from skyweave.llm.queries.registry import query, table
from skyweave.llm.workspace import Workspace


def _count(kind: str):
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")


@query("op2_personal_data")
def personal_data_spans(spark: SparkSession, folder: str) -> DataFrame:
    found = personal_data(table(spark, folder, "documents"), Workspace(spark, "pii"))
    counts = [_count(kind).alias(f"n_{kind}") for kind in KINDS]
    base = spans_text(F.col("base"))
    terms = F.array_join(
        F.transform("terms", lambda s: F.concat_ws(":", F.lit("term"), s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )
    return found.select(
        "doc_id",
        *counts,
        F.sha2(base, 256).alias("base_sha256"),
        F.concat_ws(",", F.when(base != "", base), F.when(terms != "", terms)).alias("spans"),
    )
