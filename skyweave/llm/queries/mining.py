from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyweave.llm.negatives import hard_negatives, labelled_vectors
from skyweave.llm.queries.registry import query, table
from skyweave.llm.workspace import Workspace

_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS t
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
    CAST(list_sum(list_transform(list_zip(a.t, b.t), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND b.vec_id <> a.vec_id
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
    row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place
  FROM s WHERE same
), r AS (
  SELECT p.anchor_id, positive_id,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
    s.vec_id AS negative_id, positive_score, s.score AS negative_score
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND p.place <= 5
    AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score
)
SELECT * FROM r WHERE rank <= 5
"""


@query("op11_hard_negatives", _SQL)
def hard_negatives_of_vectors(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = labelled_vectors(table(spark, folder, "embeddings"), "vec_id", "embedding", moved)
    return hard_negatives(vectors.where(F.col("id") % 100 == 0), vectors, Workspace(spark, "negatives"))
