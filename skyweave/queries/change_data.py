"""Change data over the orders table: each customer's orders are the changes of one record."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyweave.operators import changes
from skyweave.operators.sequence import plan_slices
from skyweave.queries.base import query
from skyweave.session import scratch_path
from skyweave.sources.telemetry import table


def _feed(spark, folder):
    return table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")


_GONE = "o_orderstatus = 'P'"


@query(
    "cdc_scd1",
    f"""SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM (SELECT *, row_number() OVER
    (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders) WHERE rn = 1 AND NOT ({_GONE})""",
)
def cdc_scd1(spark, folder):
    return changes.apply_latest(_feed(spark, folder), "o_custkey", "o_orderkey", F.expr(_GONE))


_HISTORY = f"""SELECT o_custkey, valid_from, valid_to, o_orderstatus, o_totalprice, valid_to IS NULL AS is_current FROM
    (SELECT *, o_orderkey AS valid_from, lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS valid_to
    FROM orders) WHERE NOT ({_GONE})"""


@query("cdc_scd2", _HISTORY)
def cdc_scd2(spark, folder):
    return changes.apply_history(_feed(spark, folder), "o_custkey", "o_orderkey", F.expr(_GONE))


@query("cdc_scd2_sliced", _HISTORY)
def cdc_scd2_sliced(spark, folder):
    feed = _feed(spark, folder)
    slices = plan_slices(feed, "o_orderkey", target_rows=1_000)
    return changes.apply_history(feed, "o_custkey", "o_orderkey", F.expr(_GONE), slices)


_DIFF = """WITH a AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'),
    b AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'C' ELSE o_orderstatus END AS o_orderstatus,
    o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01'),
    j AS (SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, a.o_orderstatus AS old_o_orderstatus,
    a.o_totalprice AS old_o_totalprice, b.o_orderstatus AS new_o_orderstatus, b.o_totalprice AS new_o_totalprice,
    CASE WHEN a.o_orderkey IS NULL THEN 'insert' WHEN b.o_orderkey IS NULL THEN 'delete'
    WHEN a.o_orderstatus IS DISTINCT FROM b.o_orderstatus OR a.o_totalprice IS DISTINCT FROM b.o_totalprice
    THEN 'update' END AS change FROM a FULL OUTER JOIN b ON a.o_orderkey = b.o_orderkey)
    SELECT * FROM j WHERE change IS NOT NULL"""


def _snapshots(spark, folder):
    orders = table(spark, folder, "orders")
    placed = F.col("o_orderdate")
    before = orders.where(placed < F.lit("1998-01-01").cast("timestamp_ntz"))
    after = orders.where(placed >= F.lit("1995-01-01").cast("timestamp_ntz")).withColumn(
        "o_orderstatus", F.when(F.col("o_orderstatus") == "F", "C").otherwise(F.col("o_orderstatus"))
    )
    return before, after


@query("snapshot_diff", _DIFF)
def snapshot_diff(spark, folder):
    before, after = _snapshots(spark, folder)
    return changes.snapshot_diff(before, after, "o_orderkey", ["o_orderstatus", "o_totalprice"])


_LATER = "(o_orderkey > (SELECT max(o_orderkey) * 3 // 4 FROM orders) AND o_orderkey % 10 = 0)"


@query(
    "digest_diff",
    f"""SELECT o_orderkey, o_orderstatus AS old_o_orderstatus, o_totalprice AS old_o_totalprice,
    CASE WHEN o_orderkey % 20 > 0 THEN o_orderstatus END AS new_o_orderstatus,
    CASE WHEN o_orderkey % 20 > 0 THEN o_totalprice + 1 END AS new_o_totalprice,
    CASE WHEN o_orderkey % 20 > 0 THEN 'update' ELSE 'delete' END AS change FROM orders WHERE {_LATER}""",
)
def digest_diff(spark, folder):
    """Changes among the late orders, found through digests: the ranges of the others are not read."""
    orders, values = table(spark, folder, "orders"), ["o_orderstatus", "o_totalprice"]
    border = F.lit(orders.agg(F.max("o_orderkey")).first()[0] * 3 // 4)
    later = (F.col("o_orderkey") > border) & (F.col("o_orderkey") % 10 == 0)
    changed = F.when(later, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    root = scratch_path(spark, "snapshots")
    orders.select("o_orderkey", *values).write.parquet(f"{root}/before")
    after = orders.where(~(later & (F.col("o_orderkey") % 20 == 0))).withColumn("o_totalprice", changed)
    after.select("o_orderkey", *values).write.parquet(f"{root}/after")
    old, new = (spark.read.parquet(f"{root}/{n}") for n in ("before", "after"))
    cuts = changes.key_cuts(old, "o_orderkey", 64)
    digests = []
    for name, df in (("before", old), ("after", new)):
        changes.digest_table(df, "o_orderkey", values, cuts).write.parquet(f"{root}/{name}-digests")
        digests.append(spark.read.parquet(f"{root}/{name}-digests"))
    return changes.digest_diff(old, new, "o_orderkey", values, cuts, *digests)
