"""From raw documents to packed training sequences: five stages, each over all its predecessor kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next one's docs.
All but the last return the columns of documents. No stage looks at anything but ``docs``, so each can be run alone. A stage's
result must be written before the next stage is called: that call deletes the tables the earlier one kept on its way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyweave.llm import mixture, neardup, packing, pii, quality
from skyweave.llm.workspace import Workspace


_kept: list[Workspace] = []


def _fresh(spark: SparkSession, name: str) -> Workspace:
    """A folder for the tables of a stage; those of the stages before it go."""
    while _kept:
        _kept.pop().close()
    _kept.append(Workspace(spark, f"stage-{name}"))
    return _kept[-1]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules, without the lines many documents of their source share; those depleted go."""
    return quality.filtered(docs, _fresh(spark, "quality"), limits=quality.HOST_LIMITS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: five-word shingles, similarity of 80 % and more."""
    return neardup.one_of_each(docs, _fresh(spark, "neardup"), neardup.Similarity(shingle=5, percent=80))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data and the terms that disclose it replaced in the text."""
    kept = docs.columns
    found = pii.personal_data(docs, _fresh(spark, "pii"), kept_cols=kept)
    clean = found.withColumn("in_text", pii.sanitised(F.col("in_text"), F.col("base"), F.col("terms")))
    touched = (F.size("base") > 0) | (F.size("terms") > 0)
    if "n_chars" in kept:
        size = F.length("in_text").cast(docs.schema["n_chars"].dataType)
        clean = clean.withColumn("in_n_chars", F.when(touched, size).otherwise(F.col("in_n_chars")))
    return clean.select(*[F.col(f"`in_{c}`").alias(c) for c in kept])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mixture takes it, in the order of the training schedule."""
    kept = docs.columns
    found = mixture.mixed(docs, _fresh(spark, "mixture"), kept_cols=kept)
    return mixture.arranged(found).select(*[F.col(f"`in_{c}`").alias(c) for c in kept])


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of every document: where in which training sequence it goes."""
    sizes = docs.select("doc_id", mixture.words_in("text").alias("size"))
    return packing.packed(sizes, _fresh(spark, "packing")).select(
        "doc_id", "piece", "start", "length", "bin_id", "capacity", "offset"
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("personal_data", personal_data),
    ("mix_sources", mix_sources),
    ("best_fit_packing", best_fit_packing),
]

#: The stages go beyond SQL; tests/llm compares them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each result is written as Parquet and read again as the next one's documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    workspace = Workspace(spark, "pipeline")
    before = None
    for name, stage in STAGES:
        docs = workspace.keep(stage(spark, docs, sf_dir), name)
        if before is not None:
            workspace.drop(before)
        before = name
    while _kept:
        _kept.pop().close()
    return docs
