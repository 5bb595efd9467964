"""Models are fitted on the whole training part, however many rows it has."""

import pytest
from pyspark.sql import functions as F

from skyweave.plans import learning
from skyweave.queries import learning as queries
from skyweave.queries.base import curated
from skyweave.session import scratch_path


@pytest.fixture(scope="module")
def large(spark):
    """More rows in the training part than the bound there was."""
    path = scratch_path(spark, "test-events")
    kinds = F.array(*[F.lit(k) for k in ("signup", "click", "view")])
    spark.range(300_000).select(
        F.col("id").alias("event_id"),
        F.timestamp_seconds(F.col("id") + 1_700_000_000).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 500).alias("user_id"),
        kinds[(F.col("id") % 3).cast("int")].alias("event_type"),
        (F.col("id") % 300).cast("double").alias("value"),
        F.lit("{}").alias("props"),
    ).write.parquet(f"{path}/events.parquet")
    return path


def test_the_whole_training_part_is_there(spark, large):
    train, held_out = queries.parts(spark, large)
    assert train.count() + held_out.count() == curated(spark, large).count()


@pytest.mark.parametrize("name", ["ml_boosting", "ml_compare"])
def test_models_see_the_whole_training_part(spark, large, monkeypatch, name):
    seen, real = [], learning.fit

    def fit(candidate, train, features, **more):
        seen.append(train.count())
        return real(learning.LOGISTIC, train.where("event_id < 2000"), features)

    monkeypatch.setattr(learning, "fit", fit)
    monkeypatch.setattr(learning, "BOOSTING_ROUNDS", {"ml_boosting": 1, "ml_compare": 2}[name])
    getattr(queries, name)(spark, large).collect()
    held_out = queries.parts(spark, large)[1].count()
    assert set(seen) == {curated(spark, large).count() - held_out}
    assert len(seen) == {"ml_boosting": 1, "ml_compare": 3}[name]
