"""Bucketed layout: same results, fewer shuffles in the big joins."""

import tempfile

import pytest

import __spark_entry__ as E
from ledgerlens.operators import cash, trades
from ledgerlens.plans.inspect import physical_plan
from ledgerlens.sources.layout import load_catalog_tables, write_bucketed_tables
from tests.conftest import SF_SMALL
from tools_compare import digest


@pytest.fixture(scope="module")
def bucketed(spark):
    if spark.conf.get("spark.sql.catalogImplementation", "in-memory") != "in-memory":
        pytest.skip("needs the in-memory catalog")
    db = "ledgerlens_bucketed_test"
    location = tempfile.mkdtemp(prefix="ledgerlens-wh-")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{location}'")
    write_bucketed_tables(E._tables(spark, SF_SMALL), db, buckets=4)
    return load_catalog_tables(spark, db)


def _exchanges(df):
    return physical_plan(df).count("Exchange hashpartitioning")


def test_bucketed_results_equal(spark, bucketed):
    plain = E._tables(spark, SF_SMALL)
    for op in (trades.trade_blotter, cash.cash_movements):
        assert digest(op(bucketed, E.TEST_SCOPE).toPandas()) == digest(op(plain, E.TEST_SCOPE).toPandas())


def test_bucketed_pairs_join_without_shuffle(spark, bucketed):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain = E._tables(spark, SF_SMALL)
        a = bucketed.activities.join(bucketed.activity_legs, bucketed.activities.id == bucketed.activity_legs.activity_id)
        b = plain.activities.join(plain.activity_legs, plain.activities.id == plain.activity_legs.activity_id)
        assert _exchanges(a) == 0 and _exchanges(b) == 2
        o = bucketed.orders.join(bucketed.order_legs, bucketed.orders.id == bucketed.order_legs.order_id)
        assert _exchanges(o) == 0
        assert _exchanges(trades.trade_blotter(bucketed, E.TEST_SCOPE)) < _exchanges(
            trades.trade_blotter(plain, E.TEST_SCOPE)
        )
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
