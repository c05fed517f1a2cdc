import pytest
from pyspark.sql import types as T


@pytest.fixture(scope="session")
def hard_documents(spark):
    """Nulls everywhere, empty and long texts, repeated rows, and columns with the names that operators use inside."""
    long = " ".join(f"word{i % 97}x{i}" for i in range(30_000))
    near = " ".join(f"w{i}" for i in range(60))
    rows = [(1, "the cat sat on the mat, again and again", "en", "a", 1), (2, "", None, None, None), (3, None, "en", None, 0),
            (4, long, "en", "b", 9), (5, near, "fr", "a", 1), (5, near, "fr", "a", 1), (6, near + " more", None, "a", 1),
            (None, near, "fr", "a", 2), (7, "  \t\n ", "de", "", 3), (8, "1234 5678 !!! ...", "de", "", 3),
            (9, "un deux trois quatre cinq six", "fr", "c", 4), (10, "é日本\x00 x\x1cy", None, "c", 4)]
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                           T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
    df = spark.createDataFrame(rows, schema)
    return df.selectExpr("*", "n_chars AS score", "source AS bucket", "doc_id AS length", "lang AS component_id", "source AS _text", "n_chars AS cell")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 0), (4, 0), (5, 1), (9, None), (None, 1), (77, 1)], "doc_id long, toxic int")


def key(row):
    return tuple((v is None, v) for v in row)
