import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make_docs(spark):
    """Documents from texts or (id, text) pairs."""

    def make(rows, lang="en"):
        pairs = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        return spark.createDataFrame(
            [(i, t, lang, "src", None if t is None else len(t)) for i, t in pairs], DOC_SCHEMA
        )

    return make


@pytest.fixture
def table(spark):
    def read(name):
        return spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")

    return read
