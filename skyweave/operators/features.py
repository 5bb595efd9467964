"""Feature tables: building, looking up, and assembling training sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyweave.sources.telemetry import KEY, ROW_ID

# Features of one observation.
ROW_FEATURES = ["baro_altitude", "geo_altitude", "velocity", "true_track"]

# How the features of one aircraft are made, as SQL aggregates.
AIRCRAFT_MEASURES = {
    "avg_velocity": "avg(velocity)",
    "max_baro_altitude": "max(baro_altitude)",
    "min_baro_altitude": "min(baro_altitude)",
    "avg_geo_altitude": "avg(geo_altitude)",
    "num_state_vectors": "CAST(count(*) AS DOUBLE)",
}
AIRCRAFT_FEATURES = list(AIRCRAFT_MEASURES)


def entity_features(df: DataFrame, *extra_keys, key: str = KEY, measures: dict[str, str] = AIRCRAFT_MEASURES) -> DataFrame:
    """Aggregate features per entity (and per extra key, such as a day)."""
    return df.groupBy(key, *extra_keys).agg(*[F.expr(text).alias(name) for name, text in measures.items()])


def lookup(
    df: DataFrame,
    features: DataFrame,
    key: str,
    names: list[str],
    *,
    row_id: str | None = None,
    hot_share: float = 0.001,
    pieces: int = 64,
) -> DataFrame:
    """Left join to a feature table with one row per key; an unknown key gets null features.

    Without ``row_id`` this is a plain join: Spark broadcasts a small feature table by its own size
    check, and AQE splits skewed partitions where both sides come straight from a scan, not where ``features`` is
    an aggregate. With ``row_id`` (something that differs between the
    rows of a key) keys holding more than ``hot_share`` of all rows are spread over ``pieces`` tasks. There
    can be at most 1 / hot_share such keys, which bounds both the broadcast list and the copied
    feature rows. Give it wherever the size of either side is unknown.
    """
    wanted = features.select(key, *names)
    if row_id is None:
        return df.join(wanted, key, "left")
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    total = counts.agg(F.sum("__n")).scalar()
    hot = counts.where(F.col("__n") > total * hot_share).select(key, F.lit(pieces).alias("__pieces"))
    spread = F.coalesce(F.col("__pieces"), F.lit(1))
    # Rows without a key match nothing, so they may go anywhere.
    dealt = F.when(F.col(key).isNull(), F.lit(pieces)).otherwise(spread)
    left = (
        df.join(F.broadcast(hot), key, "left")
        .withColumn("__piece", F.pmod(F.xxhash64(row_id), dealt).cast("int"))
        .drop("__pieces")
    )
    right = (
        wanted.join(F.broadcast(hot), key, "left")
        .withColumn("__piece", F.explode(F.sequence(F.lit(0), spread - 1)))
        .drop("__pieces")
    )
    return left.join(right, [key, "__piece"], "left").drop("__piece")


def without_nulls(df: DataFrame, columns=None) -> DataFrame:
    """Rows with every listed column present."""
    return df.dropna(how="any", subset=list(columns) if columns else None)


def training_set(
    df: DataFrame,
    features: DataFrame,
    key: str,
    feature_names: list[str],
    row_features: list[str],
    label: str,
    *,
    row_id: str = ROW_ID,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Row features, looked-up features and the label, complete rows only.

    The key and everything that gives the label away stay out unless listed in ``keep``.
    """
    rows = df.select(key, row_id, *row_features, label)
    joined = lookup(rows, features, key, feature_names, row_id=row_id)
    columns = [*row_features, *feature_names, label]
    return without_nulls(joined, columns).select(*keep, *columns)
