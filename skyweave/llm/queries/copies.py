from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skyweave.llm.exactdup import exact_duplicates
from skyweave.llm.queries.registry import query, table
from skyweave.llm.workspace import Workspace

_SQL = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS body FROM documents)
SELECT doc_id,
  max(doc_id) OVER (PARTITION BY body) AS keep_id,
  count(*) OVER (PARTITION BY body) AS group_size,
  row_number() OVER (PARTITION BY body ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
  sha256(body) AS text_sha256
FROM t
"""


@query("op13_exact_duplicates", _SQL)
def exact_duplicate_documents(spark: SparkSession, folder: str) -> DataFrame:
    found = exact_duplicates(table(spark, folder, "documents"), Workspace(spark, "exactdup"), keep="largest")
    return found.withColumnRenamed("id", "doc_id")
