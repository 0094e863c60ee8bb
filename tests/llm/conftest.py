import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])

#: Columns that operators use inside, to see that clashing names do no harm.
CLASHES = ("key", "h", "n", "id", "k", "runs", "w", "t", "row", "alive", "least", "s", "e", "i", "n_words", "cuts")


@pytest.fixture
def docs(spark):
    """Makes documents from texts or (id, text) pairs, with extra columns of clashing names."""

    def make(rows, clashes=True):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        df = spark.createDataFrame([(i, t, "en", "src", len(t) if t else None) for i, t in rows], DOCS)
        return df.selectExpr("*", *[f"'x' AS {c}" for c in CLASHES]) if clashes else df

    return make
