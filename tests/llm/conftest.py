import pytest
from samples import MESSY, frame


@pytest.fixture(scope="session")
def messy(spark):
    return frame(spark, MESSY)


@pytest.fixture(scope="session")
def nothing(spark):
    return frame(spark, [])


@pytest.fixture(scope="session")
def documents(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r[0]: r[1] for r in documents.select("doc_id", "text").collect()}
