"""Metric views, cross-filtered widgets, threshold alerts and drift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class MetricView:
    """Named measures and named dimensions over one dataset."""

    def __init__(self, measures: dict[str, Column], dimensions: dict[str, Column]):
        self.measures = measures
        self.dimensions = dimensions

    def _inputs(self, df: DataFrame, dims) -> DataFrame:
        return df.withColumns({d: self.dimensions[d] for d in dims})

    def _aggregates(self, measures):
        return [self.measures[m].alias(m) for m in (measures or self.measures)]

    def by(self, df: DataFrame, *dims: str, measures=None) -> DataFrame:
        """Measures for every combination of the dimensions' values."""
        return self._inputs(df, dims).groupBy(*dims).agg(*self._aggregates(measures))

    def cube(self, df: DataFrame, *dims: str, measures=None) -> DataFrame:
        """Measures for every subset of the dimensions; ``level`` tells which ones were rolled up."""
        return (
            self._inputs(df, dims)
            .cube(*dims)
            .agg(*self._aggregates(measures), F.grouping_id().cast("int").alias("level"))
        )


def cross_filter(df: DataFrame, selection: Column, widgets: dict[str, Column]) -> DataFrame:
    """Apply one selection to every widget of a dataset.

    A widget is a grouping column; its rows come back as (widget, item, n_rows). All widgets
    are counted in one pass: each selected row is expanded to one entry per widget and the partial
    aggregate collapses them before the shuffle.
    """
    entries = [F.struct(F.lit(w).alias("widget"), item.cast("string").alias("item")) for w, item in widgets.items()]
    return (
        df.where(selection)
        .select(F.inline(F.array(*entries)))
        .groupBy("widget", "item")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def threshold_alerts(metrics: DataFrame, measure: str, limit: float, *, above: bool = True) -> DataFrame:
    """Rows of a metric table that cross a limit."""
    value = F.col(measure)
    crossed = value > limit if above else value < limit
    return metrics.where(crossed).select(
        *[c for c in metrics.columns if c != measure],
        F.lit(measure).alias("metric"),
        value.cast("double").alias("value"),
        F.lit(float(limit)).alias("threshold"),
    )


def population_shift(
    df: DataFrame, is_reference: Column, column: str, width: float, smoothing: float = 0.5
) -> DataFrame:
    """Share of each bin in the reference and the current rows, and its term of the stability index.

    Bins present on one side only get ``smoothing`` counts on the other.
    """
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy((F.floor(F.col(column) / width) * width).cast("double").alias("bin_start"))
        .agg(
            F.count_if(is_reference).alias("n_reference"),
            F.count_if(~is_reference).alias("n_current"),
        )
    )
    totals = counts.agg(
        F.struct(
            F.sum("n_reference").alias("r"), F.sum("n_current").alias("c"), F.count(F.lit(1)).alias("bins")
        )
    ).scalar()

    def share(count: str, total: str) -> Column:
        return (F.col(count) + smoothing) / (totals[total] + smoothing * totals["bins"])

    reference, current = share("n_reference", "r"), share("n_current", "c")
    return (
        counts.withColumn("p_reference", reference)
        .withColumn("p_current", current)
        .withColumn("psi", (F.col("p_current") - F.col("p_reference")) * F.log(F.col("p_current") / F.col("p_reference")))
    )


def stability_index(shift: DataFrame, limit: float = 0.2, digits: int = 6) -> DataFrame:
    """The index over all bins and whether it calls for attention."""
    psi = F.sum("psi")
    return shift.agg(
        F.round(psi, digits).alias("psi"), (psi > limit).alias("drifted"), F.count(F.lit(1)).alias("n_bins")
    )
