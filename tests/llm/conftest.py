import pytest


@pytest.fixture
def rows(spark):
    """Rows as a data frame from tuples and a schema."""

    def make(data, schema):
        return spark.createDataFrame(data, schema)

    return make


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(rows):
    def make(*texts, ids=None, sources=None):
        ids = ids or range(len(texts))
        sources = sources or ["s"] * len(texts)
        data = [(i, t, "en", s, len(t) if t is not None else None) for i, t, s in zip(ids, texts, sources, strict=True)]
        return rows(data, DOCS)

    return make
