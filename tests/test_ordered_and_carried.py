"""Row numbers without a single-task window, bounded collection, carried keys."""

import datetime as dt
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from ledgerlens.operators import cash, positions, rates, trades
from ledgerlens.plans.inspect import physical_plan
from ledgerlens.plans.joins import carried_keys
from ledgerlens.plans.ordering import numbered, read_numbered, scratch_path, write_ordered
from ledgerlens.sources.fixtures import tables_from_rows
from tests.conftest import SF_SMALL


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key, None)
    spark.conf.set(key, "-1")
    yield spark
    spark.conf.unset(key) if old is None else spark.conf.set(key, old)


def test_numbers_follow_the_order(spark):
    # A third of all rows share a key; some are null.
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.col("id") % 50).alias("k"), "id")
    by = [F.col("k").desc_nulls_first(), F.col("id").asc()]
    got = [(r.k, r.id) for r in numbered(df, by).orderBy("row_no").collect()]
    assert got == [(r.k, r.id) for r in df.orderBy(*by).collect()]
    assert [r.row_no for r in numbered(df, by).select("row_no").orderBy("row_no").collect()] == list(range(1, 5001))


def test_numbers_of_nothing_and_of_one_partition(spark):
    assert numbered(spark.range(0), [F.col("id")]).count() == 0
    path = scratch_path(spark, "one")
    write_ordered(spark.range(10).repartition(3), path, [F.col("id").desc()], partitions=1)
    assert sorted((r.row_no, r.id) for r in read_numbered(spark, path, "row_no").collect()) == [(i + 1, 9 - i) for i in range(10)]


def test_no_window_over_rows(spark):
    plan = physical_plan(E.queries()["trade_blotter_ordered"](spark, SF_SMALL))
    # The only window runs over one row per file, and its result is broadcast.
    assert plan.count("Window [") == 1 and "BroadcastHashJoin" in plan
    assert "_n#" in next(line for line in plan.splitlines() if "Window [" in line)


def test_chunks_of_a_pair_with_a_third_of_all_codes(spark):
    d = dt.datetime(2024, 1, 1)
    codes = [("hot", f"c{i:05d}") for i in range(1000)] + [(f"u{i % 40}", f"d{i:05d}") for i in range(2000)]
    names = sorted({n for n, _ in codes})
    ids = {n: i for i, n in enumerate(names)}
    t = tables_from_rows(
        spark,
        principals=[(i, n, d) for n, i in ids.items()],
        accounts=[(i, f"A{i}", i, 1, "LIVE") for i in ids.values()],
        instruments=[(1, "EUR/USD", "FX", "[]")],
        positions=[(ids[n], 1, Decimal(1), Decimal(1), c, d) for n, c in codes for _ in range(2)],
        order_legs=[(1, c, Decimal(1), "OPEN") for _, c in codes],
        orders=[(1, "COMPLETED", "BUY", d, d, Decimal(1), 1, "{}", "[]")],
    )
    out = positions.open_position_code_chunks(t, E.TEST_SCOPE, most=64)
    got = {}
    for r in out.collect():
        assert 0 < len(r.position_codes) <= 64
        got[r.user_id, r.chunk] = r.position_codes
    assert sorted(k for k in got if k[0] == "hot") == [("hot", i) for i in range(16)]
    assert sum((got["hot", i] for i in range(16)), []) == sorted(c for n, c in codes if n == "hot")
    assert sum(map(len, got.values())) == 3000


def test_carried_keys_are_bounded(spark):
    assert carried_keys(spark.range(11).select(F.col("id") % 5), most=5).count() == 5
    assert carried_keys(spark.range(11), most=10) is None
    assert carried_keys(spark.range(3).select(F.lit(None).cast("long").alias("k"))).count() == 0


@pytest.mark.parametrize("users", [None, "Customer#000000003"])
def test_carrying_changes_no_row(spark, users):
    t, scope = E._tables(spark, SF_SMALL), replace(E.TEST_SCOPE, users=users)
    plain, carried = trades.blotter_rows(t, scope, carry=False), trades.blotter_rows(t, scope, carry=True)
    assert sorted(map(str, plain.collect())) == sorted(map(str, carried.collect()))
    one, two = positions._open_rows(t, scope, carry=False), positions._open_rows(t, scope, carry=True)
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))


def test_order_side_of_a_user_is_cut_before_its_shuffles(no_broadcast):
    t, scope = E._tables(no_broadcast, SF_SMALL), E.USERS_SCOPE
    plan = physical_plan(trades.blotter_rows(t, scope))
    # orders, order legs, opening orders and hedges, each below its exchange.
    assert plan.count("BroadcastHashJoin") == 4 and plan.count("LeftSemi, BuildRight") == 4
    # What meets the exchanges of the order side is a fraction of it.
    orders, legs = t.orders, t.order_legs
    ids = carried_keys(
        t.activities.where("activity_type = 'TRADE'").join(t.accounts, F.col("account_id") == t.accounts["id"])
        .join(scope.principals(t.principals).select(F.col("id").alias("p")), F.col("owner_id") == F.col("p")).select("order_id")
    )
    kept = orders.join(ids, orders["id"] == ids["order_id"], "left_semi").count()
    assert 0 < kept < orders.count() / 20 and legs.count() == orders.count()


def test_blotter_exchanges(no_broadcast):
    plan = physical_plan(E.queries()["trade_blotter"](no_broadcast, SF_SMALL))
    assert plan.count("Exchange hashpartitioning") < 21
    distinct = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "parameters_1" in line]
    assert distinct and all("parameters#" not in line for line in distinct)


def test_totals_merge_in_any_order_and_batches(spark):
    t, scope = E._tables(spark, SF_SMALL), E.TEST_SCOPE
    cuts = [None, dt.date(1996, 1, 1), dt.date(1996, 1, 2), dt.date(2000, 7, 3), None]
    states = [cash.cash_totals_state(t, replace(scope, date_from=a or scope.date_from), until=b) for a, b in zip(cuts, cuts[1:])]
    want = sorted(map(str, cash.cash_movements_by_period(t, scope).collect()))
    for order in (states, states[::-1]):
        merged = cash.merge_totals(cash.merge_totals(*order[:2]), *order[2:])
        assert sorted(map(str, cash.totals_from_state(merged, t.quotes_history, scope).collect())) == want


def test_rates_on_days_prune_the_months(spark):
    t, path = E._tables(spark, SF_SMALL), scratch_path(spark, "quotes")
    rates.write_quotes_by_month(t.quotes_history, path)
    days = spark.createDataFrame([(dt.date(1996, 5, 6),), (dt.date(1996, 5, 6),), (None,), (dt.date(2030, 1, 1),)], "day date")
    quotes = spark.read.parquet(path)
    out = rates.fx_rates_on_days(quotes, days, E.TEST_SCOPE)
    assert "dynamicpruning" in physical_plan(out)
    want = rates.fx_daily_rates(t.quotes_history, E.TEST_SCOPE).where("transaction_time = DATE '1996-05-06'")
    assert sorted(map(str, out.collect())) == sorted(map(str, want.collect()))
    plain = rates.fx_rates_on_days(t.quotes_history, days, E.TEST_SCOPE)  # without the layout
    assert sorted(map(str, plain.collect())) == sorted(map(str, want.collect()))
