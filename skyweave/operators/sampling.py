"""Samples and splits.

The ``hashed`` forms depend only on row identity, so they are the same on any cluster and after any
retry, and a row can never be in both the training and the evaluation part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyweave.functions.hashing import BUCKET_SPACE, row_bucket
from skyweave.sources.telemetry import ROW_ID


def _fraction(df: DataFrame, target_rows: int) -> Column:
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return F.least(F.lit(1.0), target_rows / F.greatest(total, F.lit(1)))


def uniform_sample(df: DataFrame, target_rows: int, seed: int, row_id: str = ROW_ID) -> DataFrame:
    """About ``target_rows`` rows chosen by hash; all rows when there are fewer."""
    return df.where(row_bucket(seed, F.col(row_id)) < _fraction(df, target_rows) * BUCKET_SPACE)


def stratified_sample(df: DataFrame, label: str, target_rows: int, seed: int, row_id: str = ROW_ID) -> DataFrame:
    """Proportional sample: the same fraction of every class, decided class by class."""
    picked = row_bucket(seed, F.col(label), F.col(row_id)) < _fraction(df, target_rows) * BUCKET_SPACE
    return df.where(F.col(label).isNotNull() & picked)


def stratified_native(df: DataFrame, label: str, classes, target_rows: int, seed: int) -> DataFrame:
    """Bernoulli sample per class with Spark's generator; depends on the partitioning."""
    total = df.count()
    fraction = min(1.0, target_rows / total) if total else 1.0
    return df.sampleBy(label, {c: fraction for c in classes}, seed=seed)


def split(df: DataFrame, label: str, train_percent: int = 80, seed: int = 42, row_id: str = ROW_ID) -> DataFrame:
    """Mark each row ``train`` or ``test``, hashing within each class."""
    lot = row_bucket(seed, F.col(label), F.col(row_id)) % 100
    return df.withColumn("part", F.when(lot < train_percent, "train").otherwise("test"))
