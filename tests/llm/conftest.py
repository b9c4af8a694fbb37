import pytest


@pytest.fixture
def docs(spark):
    """A documents table from (doc_id, text) pairs, with columns of clashing names."""

    def make(rows):
        full = [(i, t, "en", "s", None if t is None else len(t), 1.5, "x") for i, t in rows]
        return spark.createDataFrame(
            full, "doc_id long, text string, lang string, source string, n_chars long, score double, _key string"
        )

    return make
