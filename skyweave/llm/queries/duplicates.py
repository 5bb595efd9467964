from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skyweave.llm.neardup import Similarity, near_duplicates
from skyweave.llm.queries.registry import query, table
from skyweave.llm.workspace import Workspace

_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT doc_id, CASE
    WHEN w IS NULL OR len(w) = 0 THEN []
    WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
    END AS sh
  FROM w
), n AS (
  SELECT doc_id, CAST(len(sh) AS BIGINT) AS n_shingles FROM s
), e AS (
  SELECT doc_id, unnest(sh) AS g FROM s
), rare AS (
  SELECT e.doc_id, e.g, n_shingles,
    row_number() OVER (PARTITION BY e.doc_id ORDER BY f.c, e.g) AS place
  FROM e JOIN n USING (doc_id) JOIN (SELECT g, count(*) AS c FROM e GROUP BY g) f ON f.g = e.g
), p AS (
  SELECT DISTINCT a.doc_id AS x, b.doc_id AS y
  FROM rare a JOIN rare b ON a.g = b.g AND a.doc_id < b.doc_id
  WHERE 100 * a.place <= 15 * a.n_shingles + 100 AND 100 * b.place <= 15 * b.n_shingles + 100
    AND 100 * least(a.n_shingles, b.n_shingles) >= 85 * greatest(a.n_shingles, b.n_shingles)
), l AS (
  SELECT x, y FROM p JOIN e a ON a.doc_id = p.x JOIN e b ON b.doc_id = p.y AND b.g = a.g
    JOIN n m ON m.doc_id = p.x JOIN n o ON o.doc_id = p.y
  GROUP BY x, y, m.n_shingles, o.n_shingles
  HAVING 100 * count(*) >= 85 * (m.n_shingles + o.n_shingles - count(*))
), reach(a, b) AS (
  SELECT doc_id, doc_id FROM n
  UNION
  SELECT r.a, k.y FROM reach r JOIN (SELECT x, y FROM l UNION ALL SELECT y, x FROM l) k ON k.x = r.b
), c AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM n JOIN c USING (doc_id)
"""


@query("op1_near_duplicates", _SQL)
def near_duplicate_documents(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(
        table(spark, folder, "documents"), Workspace(spark, "neardup"), Similarity(shingle=3, percent=85)
    )
    return found.select("doc_id", "n_shingles", "component_id", "kept")
