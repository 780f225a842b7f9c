import pytest

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, root long"


@pytest.fixture
def make_docs(spark):
    """Documents from texts, or from (doc_id, text); further columns clash with internal names."""

    def make(rows):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        return spark.createDataFrame(
            [(i, t, "en", "s", None if t is None else len(t), 0.5, 7) for i, t in rows], DOCS)

    return make


@pytest.fixture(scope="session")
def sf_docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def sf_labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")
