import random

import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in any column, blank, repeated and very long texts, shared ids."""
    rng = random.Random(5)
    body = " ".join(words(rng, 120, 5000))
    long = " ".join(words(rng, 30_000, 9000)) + " " + "x" * 20_000
    return [
        (1, body, "en", "a", len(body)), (2, body, "en", None, len(body)), (2, body, "en", None, len(body)),
        (3, None, None, None, None), (4, "", "en", "a", 0), (5, " \t\n\r ", "en", "a", 5),
        (None, body + " more", "en", "a", 1), (None, None, None, None, None), (6, long, "fr", "b", len(long)),
        (7, "One line\nOne line\n\none LINE\nlast # line", "en", "a", 38), (8, "ééé ñ 世界 ▁ \U0001F600\x00 z", "es", "a", 14),
        (9, "a b", "en", "a", 3), (9, "c d", "en", "a", 3),
    ]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    return spark.createDataFrame(edge_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def clashing(df, *names):
    """The table with more columns of the given names."""
    from pyspark.sql import functions as F
    for n in names:
        df = df.withColumn(n, F.lit("x"))
    return df
