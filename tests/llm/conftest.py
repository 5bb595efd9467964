import pytest


@pytest.fixture()
def workspace(spark):
    from skyweave.llm.workspace import Workspace

    made = Workspace(spark, "test")
    yield made
    made.close()


@pytest.fixture(scope="session")
def tables(spark, folder):
    return lambda name: spark.read.parquet(f"{folder}/{name}.parquet")
