from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyweave.llm.queries.registry import query, table
from skyweave.llm.topk import quantised, top_k
from skyweave.llm.workspace import Workspace

TOP = 20

_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS t
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_sum(list_transform(list_zip(q.t, c.t), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id, score
  FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


@query("op10_topk_search", _SQL)
def topk_search(spark: SparkSession, folder: str) -> DataFrame:
    vectors = quantised(table(spark, folder, "embeddings"), "vec_id", "embedding")
    return top_k(vectors.where(F.col("id") % 20 == 0), vectors, TOP, Workspace(spark, "topk"))
