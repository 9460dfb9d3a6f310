import pytest

EXTRA = "lang string, source string, n_chars bigint, hits string, score string, found string"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Builds documents from (doc_id, text) pairs, with further columns of clashing names."""

    def build(rows, lang="en"):
        full = [(i, t, lang, "s", None if t is None else len(t), "x", "y", None) for i, t in rows]
        return spark.createDataFrame(full, f"doc_id bigint, text string, {EXTRA}")

    return build


@pytest.fixture(scope="session")
def small(spark):
    """The smallest test documents."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
