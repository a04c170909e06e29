import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """Makes a table of documents from (id, text) or (id, text, source) tuples, with extra clashing columns."""

    def make(rows, extra=True):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        if not extra:
            return df
        from pyspark.sql import functions as F

        # Names that the operators use inside.
        names = ("id", "key", "node", "t", "h", "ws", "queue", "n", "hs", "th", "host", "kept", "spans", "x", "class", "band", "new", "toks")
        return df.withColumns({n: F.lit(7) for n in names})

    return make


@pytest.fixture(scope="session")
def small_documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
