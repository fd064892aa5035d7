import pytest


def make_docs(spark, rows):
    """rows of (doc_id, text)."""
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.fixture
def docs_of(spark):
    return lambda rows: make_docs(spark, rows)


SF = "/root/testdata/sf0.001"
