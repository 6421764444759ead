import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang) rows; sources and lengths are missing."""
    def make(rows):
        return spark.createDataFrame([(*r, *(None,) * (5 - len(r))) for r in rows], DOCS)
    return make
