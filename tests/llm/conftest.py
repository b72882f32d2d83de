import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """A documents table from (doc_id, text) pairs, with columns whose names operators use inside."""
    def build(*rows, lang="en"):
        full = [(i, t, lang, "s", None if t is None else len(t), "x", 7, 8) for i, t in rows]
        return spark.createDataFrame(full, DOCS + ", row_key string, spans int, words int").repartition(3)

    return build
