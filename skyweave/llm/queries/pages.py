from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skyweave.llm.html import extracted
from skyweave.llm.queries.registry import query, table


@query("op3_html_extraction")
def html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return extracted(table(spark, folder, "pages")).select("page_id", "url", "text", "n_chars")
