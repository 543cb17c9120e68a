import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType())])
# names that operators use themselves
CLASHING = ["row", "words", "score", "key", "th", "b", "id", "root", "pos", "line", "text_"]


def sentence(rng, n, vocab=2000):
    return " ".join(f"w{rng.randrange(vocab)}" for _ in range(n))


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    """The tables here are tiny; many tasks would only cost time."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", old)


@pytest.fixture(scope="session")
def odd_rows():
    """Rows with nulls in every column, empty and very long texts, ties and repeats."""
    rng = random.Random(5)
    long_text = sentence(rng, 40_000)
    one_line = "\n".join(["the same line again and again here"] * 300)
    plain = sentence(rng, 120)
    rows = [(1, None, "en", "s", 0), (2, "", "en", "s", 0), (3, " \n\t ", "en", None, 3), (None, plain, "en", "s", None),
            (4, plain, None, "s", 1), (4, plain, None, "s", 1), (5, plain + " x", "de", "s", 1), (6, long_text, "en", "s", 9),
            (7, "a" * 30_000, "en", "s", 9), (8, one_line, "en", "s", 9), (9, "Ünïcode 😀 文字 \x00   ok", "xx", "s", 9),
            (None, None, None, None, None), (10, "one two", "en", "s", 2), (11, "ONE two", "en", "s", 2)]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(odd_rows, SCHEMA)
    return df.withColumns({c: F.lit(f"extra {c}") for c in CLASHING})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small_docs(spark, sf_dir):
    import os
    path = os.path.join(os.path.dirname(sf_dir), "sf0.001", "documents.parquet")
    return spark.read.parquet(path)
