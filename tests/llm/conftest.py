import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, shard int, size long, score double"


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from (doc_id, text[, lang[, source]]), with further columns whose names clash."""
    def make(rows):
        full = [(*r, *(None,) * (4 - len(r)), None if r[1] is None else len(r[1]), 7, 8, 0.5) for r in rows]
        return spark.createDataFrame(full, DOCS)
    return make


@pytest.fixture(scope="session")
def shared(spark):
    return spark
