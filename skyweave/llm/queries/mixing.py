from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyweave.llm.mixture import mixed, words_in
from skyweave.llm.packing import packed
from skyweave.llm.queries.registry import query, table
from skyweave.llm.workspace import Workspace

_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 13) AS BIGINT) AS place
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(sum(sum(size)) OVER () AS BIGINT) AS total,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM d GROUP BY source
), l AS (
  SELECT source, source_size, w,
    CAST(total - coalesce(sum(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
      / CAST(sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
  FROM s WINDOW o AS (ORDER BY 3 * source_size / CAST(w AS DOUBLE), source NULLS LAST)
), t AS (
  SELECT source, source_size, least(CAST(3 * source_size AS DOUBLE), max(level) OVER () * CAST(w AS DOUBLE)) AS target FROM l
), p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS whole,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.place, d.doc_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  CAST(CASE WHEN target > 0 THEN
    size * least(whole + CASE WHEN start + size / 2.0 < target - whole * source_size THEN 1 ELSE 0 END, 3)
    ELSE 0 END AS BIGINT) AS taken
FROM p
"""


@query("op4_mix_sources", _SQL)
def mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    found = mixed(table(spark, folder, "documents"), Workspace(spark, "mixture"))
    # Documents that are not taken come after all others, spread over as many partitions.
    after = F.lit(1.0) + F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1_000_000
    first = F.coalesce(F.array_min("positions"), after)
    return found.orderBy(first).select("doc_id", "size", "source_size", "target", "taken")


@query("op7_best_fit_packing")
def best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    sizes = table(spark, folder, "documents").select("doc_id", words_in("text").alias("size"))
    return packed(sizes, Workspace(spark, "packing")).select(
        "doc_id", "piece", "start", "length", "bin_id", "capacity", "offset"
    )
