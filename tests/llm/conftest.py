import pytest
from pyspark.sql import Row

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from texts (ids count up) or (id, text) pairs."""
    def make(rows, schema=DOCS):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], schema)
    return make


@pytest.fixture(scope="session")
def documents(spark, sf_small):
    return spark.read.parquet(f"{sf_small}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def run_query(spark, sf_small):
    from rankforge.llm.queries import QUERIES
    from rankforge.session import configure

    def run(name) -> list[Row]:
        configure(spark)
        return QUERIES[name](spark, sf_small).collect()
    return run
