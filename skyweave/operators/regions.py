"""Longitude bands.

The bands overlap by definition (60..75 is in two, -170..-120 is in two, -30 is in two), so
``overlap`` mode can put one row into several regions; ``exclusive`` mode takes the first match.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Closed longitude intervals of each region, in order of precedence.
BANDS = {
    "Americas": ((-170.0, -30.0),),
    "EMEA": ((-30.0, 75.0),),
    "APAC": ((60.0, None), (None, -120.0)),
}


def in_region(region: str, longitude="longitude", bands=BANDS) -> Column:
    """Membership of one region; null longitude gives null."""
    lon = F.col(longitude)

    def inside(low, high):
        if low is None:
            return lon <= high
        if high is None:
            return lon >= low
        return lon.between(low, high)

    return reduce(lambda a, b: a | b, [inside(*interval) for interval in bands[region]])


def regions_of(longitude="longitude", bands=BANDS) -> Column:
    """Array of the regions a longitude belongs to."""
    return F.array_compact(F.array(*[F.when(in_region(r, longitude, bands), F.lit(r)) for r in bands]))


def fan_out(df: DataFrame, longitude="longitude", bands=BANDS) -> DataFrame:
    """One output row per region a row belongs to, in a single scan."""
    return df.withColumn("region", F.explode(regions_of(longitude, bands)))


def assign_exclusive(df: DataFrame, longitude="longitude", bands=BANDS) -> DataFrame:
    """At most one region per row; rows outside every band get null."""
    names = list(bands)
    chain = F.when(in_region(names[0], longitude, bands), names[0])
    for name in names[1:]:
        chain = chain.when(in_region(name, longitude, bands), name)
    return df.withColumn("region", chain)


def route(df: DataFrame, mode: str = "overlap", longitude="longitude", bands=BANDS) -> DataFrame:
    """Rows tagged with their region; rows without one are dropped in both modes."""
    if mode == "overlap":
        return fan_out(df, longitude, bands)
    if mode == "exclusive":
        return assign_exclusive(df, longitude, bands).where(F.col("region").isNotNull())
    raise ValueError(f"unknown region mode: {mode}")


def union_tagged(tables: dict[str, DataFrame], tag: str = "region") -> DataFrame:
    """Union of separate regional tables, each row tagged with its table."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), tagged)


def overlap_audit(df: DataFrame, longitude="longitude", bands=BANDS) -> DataFrame:
    """Rows by the set of regions they fall into, unassigned rows included."""
    found = regions_of(longitude, bands)
    return (
        df.select(F.array_join(found, "+").alias("regions"), F.size(found).alias("n_regions"))
        .groupBy("regions", "n_regions")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def regional_summary(routed: DataFrame) -> DataFrame:
    """Analytics over the routed rows, one row per region."""
    return routed.groupBy("region").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("icao24").alias("n_aircraft"),
        F.round(F.avg("velocity"), 6).alias("avg_velocity"),
        F.round(F.avg("baro_altitude"), 6).alias("avg_baro_altitude"),
        F.max("baro_altitude").alias("max_baro_altitude"),
        F.count_if(F.col("on_ground")).alias("n_on_ground"),
        F.min("time_position").alias("first_seen"),
        F.max("time_position").alias("last_seen"),
    )
