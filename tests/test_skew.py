"""Hot keys: rows that skip a lookup must not pile into one partition, and
AQE must split a hot join key."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.plans.joins import lookup_join


@pytest.fixture
def no_broadcast_no_aqe(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")
    old = {k: spark.conf.get(k, None) for k in keys}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _largest_partition_share(df):
    sizes = [r[1] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    return max(sizes) / sum(sizes)


def test_lookup_join_spreads_rows_that_skip_the_lookup(no_broadcast_no_aqe):
    spark = no_broadcast_no_aqe
    # 9 in 10 rows need no hedge and all carry the default hedge id 0.
    left = spark.range(20000).select(
        F.col("id").alias("o_id"),
        (F.col("id") % 10 == 0).alias("is_fx"),
        F.when(F.col("id") % 10 == 0, F.col("id") % 97).otherwise(F.lit(0)).alias("hedge_id"),
    )
    right = spark.range(100).select(F.col("id").alias("h_order"), (F.col("id") * 2).alias("h_price"))

    salted = lookup_join(left, right, F.col("is_fx"), F.col("hedge_id"), F.col("h_order"), F.col("o_id"))
    naive = left.join(right, F.col("is_fx") & (F.col("hedge_id") == F.col("h_order")), "left")

    assert salted.count() == naive.count() == 20000
    assert salted.where(F.col("h_price").isNotNull()).count() == naive.where(F.col("h_price").isNotNull()).count()
    assert _largest_partition_share(salted) < 0.3
    assert _largest_partition_share(naive) > 0.85


def test_aqe_splits_a_hot_join_key(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        # One account holds a third of all activity rows.
        acts = spark.range(30000).select(
            F.col("id").alias("a_id"), F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("a_account")
        )
        accts = spark.range(30000).select(F.col("id").alias("acc_id"), F.concat(F.lit("A"), F.col("id")).alias("code"))
        joined = acts.join(accts, F.col("a_account") == F.col("acc_id"))
        assert len(joined.collect()) == 30000  # runs this DataFrame's own plan
        final = joined._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in final
        assert "isSkew=true" in final or "skew=true" in final.lower()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_aqe_splits_a_hot_key_before_an_aggregate_on_it(spark):
    """Join then distinct on keys that include the join key (the trade
    blotter's shape): the hot order is still split."""
    from ledgerlens.session import configure_session

    configure_session(spark)
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        trades = spark.range(30000).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("a_order"),
            (F.col("id") % 5).alias("qty"),
        )
        orders = spark.range(30000).select(F.col("id").alias("o_id"), (F.col("id") % 2).alias("side"))
        out = trades.join(orders, F.col("a_order") == F.col("o_id")).select("a_order", "qty", "side").distinct()
        got = out.collect()
        final = out._jdf.queryExecution().executedPlan().toString()
        assert len(got) == out.count()
        assert "skew=true" in final.lower()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
