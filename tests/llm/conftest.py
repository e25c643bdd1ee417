import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names clash with ones that the operators use or add.
CLASH = ["n", "h", "key", "pos", "rank", "digest", "cid", "size", "label", "kept", "score", "n_words", "_key", "_text", "_pos", "_role", "piece", "tree"]


@pytest.fixture
def docs(spark):
    """A frame of documents from texts, with clashing extra columns on request."""

    def make(texts, clash=True, ids=None):
        from pyspark.sql import functions as F

        ids = ids or list(range(len(texts)))
        df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in zip(ids, texts, strict=True)], DOCS)
        return df.withColumns({c: F.lit("x") for c in CLASH}) if clash else df

    return make


@pytest.fixture
def words():
    import random

    r = random.Random(5)
    return lambda n: " ".join("".join(r.choice("abcdefgh") for _ in range(4)) for _ in range(n))
