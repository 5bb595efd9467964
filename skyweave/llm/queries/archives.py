from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skyweave.llm.queries.registry import query, table
from skyweave.llm.warc import read_archives, write_archives
from skyweave.llm.workspace import Workspace

_SQL = """
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
    sha1(coalesce(html, '')) AS payload_digest
  FROM pages
), g AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS best FROM p
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> best THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> best THEN best END AS refers_to
FROM g
"""


@query("op8_warc", _SQL)
def warc(spark: SparkSession, folder: str) -> DataFrame:
    workspace = Workspace(spark, "warc")
    listing = write_archives(table(spark, folder, "pages"), workspace)
    found = read_archives(listing, workspace.folder("archives"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
