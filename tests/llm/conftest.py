import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("node", T.StringType()),
    T.StructField("id", T.IntegerType()), T.StructField("row_key", T.StringType()), T.StructField("score", T.DoubleType())])

WORDS = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen".split()


@pytest.fixture
def docs(spark):
    """Builds documents with columns whose names clash with those the operators use inside."""
    def build(rows):
        return spark.createDataFrame([(k, t, "n", 7, "r", 0.5) for k, t in rows], DOCS)
    return build


@pytest.fixture
def odd_rows():
    """Null, empty, blank and very long texts, ties, a repeated row and a repeated id."""
    long = " ".join(f"{a}{b}" for b in range(400) for a in WORDS)
    return [(1, None), (2, ""), (3, " \t\n"), (4, "alpha beta gamma delta"), (4, "alpha beta gamma delta"),
            (5, "alpha  beta gamma\ndelta"), (None, "alpha beta gamma delta"), (6, long), (7, long + " more"), (8, "x" * 5000),
            (9, "Ünï cödé 日本語 😀 ▁ text"), (9, "another text of the same id"), (10, "short")]
