import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty, blank and long texts, repeated rows and ids, a null id, and
    extra columns whose names clash with operators' own or differ in case only."""
    long = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))
    rows = [
        (1, "a b c d e\nf g h\ni j k\nl m n"),
        (1, "a b c d e\nf g h\ni j k\nl m n"),
        (1, "another text under a repeated id"),
        (2, None),
        (3, ""),
        (4, " \t\n \n"),
        (5, long),
        (6, "a b c d e\nf g h\ni j k\nl m n"),
        (7, "x" * 40_000),
        (None, "a text without an id"),
        (None, None),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for clash in ("k1", "fp", "size", "_row", "_score", "shard", "failed", "length", "DOC_ID_", "start", "first"):
        df = df.withColumn(clash, F.lit("clash"))
    return df.repartition(3)


@pytest.fixture(scope="session")
def odder(odd):
    """Also a column that differs from ``text`` in case only."""
    return odd.toDF(*[c if c != "DOC_ID_" else "TEXT" for c in odd.columns])


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")
