import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def docs(spark):
    """Build a documents table from texts; ids count from 0."""

    def build(*texts, ids=None):
        rows = [(i, t, "en", "s", len(t or "")) for i, t in zip(ids or range(len(texts)), texts)]
        return spark.createDataFrame(rows, DOCS)

    return build


@pytest.fixture
def stored_docs(docs, tmp_path, spark):
    """The same as a table scan, as operators that number rows ask for."""

    def build(*texts, ids=None):
        path = f"{tmp_path}/docs-{abs(hash(texts))}"
        docs(*texts, ids=ids).repartition(3).write.parquet(path)
        return spark.read.parquet(path)

    return build
