"""Change data: applying it, keeping its history, and finding it between two snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyweave.operators.sequence import Slices, ordered_scan
from skyweave.sources.scan import page_starts


def apply_latest(changes: DataFrame, key: str, sequence: str, is_delete: Column) -> DataFrame:
    """Type 1: the newest state of every key, deleted keys left out.

    An aggregate, so the many changes of a hot key are reduced before the shuffle.
    """
    rest = [c for c in changes.columns if c != key]
    state = changes.groupBy(key).agg(
        F.max_by(F.struct(*rest, is_delete.alias("__gone")), F.col(sequence)).alias("__row")
    )
    return state.select(key, "__row.*").where(~F.col("__gone")).drop("__gone")


def apply_history(
    changes: DataFrame, key: str, sequence: str, is_delete: Column, slices: Slices | None = None
) -> DataFrame:
    """Type 2: every state of every key with its half-open validity.

    A delete ends the state before it and opens none.
    """
    following = ordered_scan(
        changes.withColumn("__gone", is_delete),
        [key],
        sequence,
        previous={"valid_to": F.col(sequence)},
        descending=True,
        slices=slices,
    )
    return (
        following.where(~F.col("__gone"))
        .withColumnRenamed(sequence, "valid_from")
        .withColumn("is_current", F.col("valid_to").isNull())
        .drop("__gone")
    )


def snapshot_diff(before: DataFrame, after: DataFrame, key: str, values: list[str]) -> DataFrame:
    """Rows inserted, updated or deleted between two snapshots with the same key."""
    old = before.select(key, *[F.col(v).alias(f"old_{v}") for v in values], F.lit(True).alias("__old"))
    new = after.select(key, *[F.col(v).alias(f"new_{v}") for v in values], F.lit(True).alias("__new"))
    same = F.lit(True)
    for v in values:
        same = same & F.col(f"old_{v}").eqNullSafe(F.col(f"new_{v}"))
    change = (
        F.when(F.col("__old").isNull(), "insert")
        .when(F.col("__new").isNull(), "delete")
        .when(~same, "update")
    )
    return (
        old.join(new, key, "full_outer")
        .withColumn("change", change)
        .where(F.col("change").isNotNull())
        .drop("__old", "__new")
    )


def key_cuts(df: DataFrame, key: str, ranges: int = 256) -> list:
    """Keys that cut a table into about ``ranges`` ranges of equal size, at most that many."""
    rows = df.count()
    return page_starts(df.select(key), key, max(1, -(-rows // ranges)))[1:]


def range_of(key: str, cuts: list) -> Column:
    """Number of the range a key is in: the number of cuts not above it."""
    return F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col(key))) if cuts else F.lit(0)


def digest_table(df: DataFrame, key: str, values: list[str], cuts: list) -> DataFrame:
    """One row per key range: number of rows and two digests of all of them that do not depend on their order."""
    row = F.struct(key, *values)
    low, high = F.xxhash64(F.to_json(row, {"ignoreNullFields": "false"})), F.xxhash64(F.lit(1), F.to_json(row, {"ignoreNullFields": "false"}))
    return df.groupBy(range_of(key, cuts).alias("key_range")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.bit_xor(low).alias("digest_a"), F.sum(high.cast("decimal(38,0)")).alias("digest_b")
    )


def differing_ranges(before: DataFrame, after: DataFrame) -> list[int]:
    """The key ranges whose digests differ, from two digest tables with the same cuts."""
    names = ["n_rows", "digest_a", "digest_b"]
    old = before.select("key_range", F.struct(*names).alias("old"))
    new = after.select("key_range", F.struct(*names).alias("new"))
    differ = old.join(new, "key_range", "full_outer").where(~F.col("old").eqNullSafe(F.col("new")))
    return sorted(r.key_range for r in differ.select("key_range").collect())


def in_ranges(key: str, ranges: list[int], cuts: list) -> Column:
    """Rows of these key ranges, as comparisons with the key that reach the scan; neighbouring ranges are one comparison."""
    wanted = F.lit(False)
    for first, last in _runs(ranges):
        part = F.lit(True)
        if first > 0:
            part = part & (F.col(key) >= F.lit(cuts[first - 1]))
        if last < len(cuts):
            part = part & (F.col(key) < F.lit(cuts[last]))
        wanted = wanted | part
    return wanted


def _runs(numbers: list[int]) -> list[tuple[int, int]]:
    runs: list[tuple[int, int]] = []
    for n in numbers:
        if runs and runs[-1][1] == n - 1:
            runs[-1] = (runs[-1][0], n)
        else:
            runs.append((n, n))
    return runs


def digest_diff(
    before: DataFrame, after: DataFrame, key: str, values: list[str], cuts: list, before_digests: DataFrame, after_digests: DataFrame
) -> DataFrame:
    """``snapshot_diff`` of two snapshots whose digest tables are kept with them: only key ranges with different digests are read and
    joined. Keys must be unique and not null. Digests of equal ranges are equal; of different ones they agree by chance with a probability of
    about 2^-128 each."""
    ranges = differing_ranges(before_digests, after_digests)
    wanted = in_ranges(key, ranges, cuts)
    return snapshot_diff(before.where(wanted), after.where(wanted), key, values)
