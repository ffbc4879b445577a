import pytest


@pytest.fixture
def documents(spark):
    """A table of documents from texts, or from pairs of doc_id and text."""

    def make(*texts, extra=""):
        rows = [t if isinstance(t, tuple) else (n, t) for n, t in enumerate(texts)]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        return docs.selectExpr("*", *extra.split(";")) if extra else docs

    return make
