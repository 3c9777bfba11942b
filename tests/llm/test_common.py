from pyspark.sql import functions as F

from ledgerlens.llm.common import key_filter, split_by_keys


def test_filter_loses_no_key(spark):
    df = spark.range(4000).select("id", F.xxhash64("id").alias("k1"), F.lit("x").alias("text"))
    keys = df.where("id % 7 = 0").select("k1")
    maybe, rest = split_by_keys(df, F.col("k1"), key_filter(keys))
    ids = {r.id for r in maybe.collect()}
    assert maybe.columns == df.columns and ids >= set(range(0, 4000, 7)) and len(ids) < 4000 // 7 + 10
    assert {r.id for r in rest.collect()} == set(range(4000)) - ids


def test_filter_of_nothing(spark):
    df = spark.range(10).select("id", F.xxhash64("id").alias("k1"))
    maybe, rest = split_by_keys(df, F.col("k1"), key_filter(df.limit(0)))
    assert maybe.count() == 0 and rest.count() == 10
