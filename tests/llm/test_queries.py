"""Every corpus query with a SQL text against DuckDB, the others against whole-table facts."""

import pytest

from skyweave.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, folder, con, name):
    import harness

    assert harness.differences(QUERIES[name](spark, folder), con, ORACLES[name]) == []


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_whole_table(spark, folder, name):
    found = QUERIES[name](spark, folder)
    key = "page_id" if "page_id" in found.columns else "doc_id"
    source = spark.read.parquet(f"{folder}/{'pages' if key == 'page_id' else 'documents'}.parquet")
    assert found.select(key).distinct().count() == source.count()
    assert found.select(key).exceptAll(source.select(key)).select(key).join(source, key, "left_anti").count() == 0
