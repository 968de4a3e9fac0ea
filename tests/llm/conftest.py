import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Texts as a documents table whose other columns clash with names the operators use."""

    def make(texts, ids=None):
        ids = range(len(texts)) if ids is None else ids
        rows = [(i, t, None, "s", None, 1.0, True, "k") for i, t in zip(ids, texts, strict=True)]
        return spark.createDataFrame(rows, f"{COLUMNS}, score double, kept boolean, key string")

    return make
