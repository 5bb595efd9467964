"""Scans beyond a plain table read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyweave.functions.predicates import hint_to_column
from skyweave.operators.sequence import ordered_scan, plan_slices


def preview(df: DataFrame, order: list[str], n: int = 10) -> DataFrame:
    """First n rows in a stated order, so two runs show the same rows."""
    return df.orderBy(*order).limit(n)


def hinted_scan(df: DataFrame, hint: str | dict) -> DataFrame:
    """Exact filter from a JSON hint; comparisons on stored columns reach the Parquet reader."""
    return df.where(hint_to_column(hint))


def hinted_read(df: DataFrame, hint: str | dict, limit: int, order: list[str]) -> DataFrame:
    """Shared-table read: the limit counts rows before the exact filter, so fewer may come back."""
    return df.orderBy(*order).limit(limit).where(hint_to_column(hint))


def low_altitude(df: DataFrame, below: float = 3000.0, altitude: str = "baro_altitude") -> DataFrame:
    """The six identifying columns of everything flying low."""
    return df.where(F.col(altitude) < below).select(
        "icao24", "callsign", "time_position", "latitude", "longitude", altitude
    )


def keyset_page(df: DataFrame, key: str, after, size: int) -> DataFrame:
    """The next ``size`` rows after a key. The filter reaches the scan, so late pages cost no more."""
    rows = df if after is None else df.where(F.col(key) > after)
    return rows.orderBy(key).limit(size)


def keyset_pages(df: DataFrame, key: str, size: int, after=None):
    """All pages after a key, one after the other; each asks for the last key of the page before. Keys must be unique."""
    while True:
        page = keyset_page(df, key, after, size)
        last = page.agg(F.max(key).alias("last")).first().last
        if last is None:
            return
        yield page
        after = last


def page_starts(df: DataFrame, key: str, size: int) -> list:
    """The first key of every page of ``size`` rows, in order, from running counts over the key alone. Keys must be unique and not null.

    The list has rows / ``size`` entries, so ask for pages of many rows.
    """
    keys = df.select(key)
    ranked = ordered_scan(keys, [], key, running={"through": F.lit(1)}, slices=plan_slices(keys, key))
    starts = ranked.where((F.col("through") - 1) % size == 0).select(key).collect()
    return sorted(r[0] for r in starts)


def ranged_pages(df: DataFrame, key: str, size: int) -> list[DataFrame]:
    """All pages of ``size`` rows as ranges of the key: a page is a filter that reaches the scan, without a sort, and pages can be read
    in any order or all at once."""
    starts = page_starts(df, key, size)
    pages = [df.where((F.col(key) >= low) & (F.col(key) < high)) for low, high in zip(starts, starts[1:])]
    return pages + [df.where(F.col(key) >= low) for low in starts[-1:]]


def csv_scan(spark: SparkSession, path: str, schema: T.StructType, json_arrays: dict[str, str]) -> DataFrame:
    """Typed CSV read. Array columns travel as JSON text and are parsed after the read.

    Declaring the schema keeps octal codes as text (inference would drop leading zeros) and saves
    the inference pass.
    """
    flat = T.StructType(
        [T.StructField(f.name, T.StringType() if f.name in json_arrays else f.dataType) for f in schema.fields]
    )
    df = spark.read.schema(flat).option("header", True).option("escape", '"').csv(path)
    return df.withColumns({name: F.from_json(name, kind) for name, kind in json_arrays.items()})
