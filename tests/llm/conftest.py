import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, h1 long, score string"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents with columns whose names clash with the operators' own."""

    def make(rows):
        return spark.createDataFrame([(i, t, lang, source, None if t is None else len(t), "k", 1, "s") for i, t, lang, source in rows], DOCS)

    return make
