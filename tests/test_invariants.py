"""Properties that must hold on the driver's data."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from ledgerlens.operators import cash, positions, rates, trades
from ledgerlens.scope import Scope
from tests.conftest import SF_SMALL


def _t(spark):
    return E._tables(spark, SF_SMALL)


def test_fx_unique_per_day_and_currency(spark):
    fx = rates.fx_daily_rates(_t(spark).quotes_history, E.TEST_SCOPE)
    assert fx.count() == fx.select("transaction_time", "quote_currency").distinct().count()


def test_pivot_totals_equal_row_totals(spark):
    t = _t(spark)
    rows = cash.cash_movements(t, E.TEST_SCOPE)
    weekly = cash.cash_movements_by_period(t, E.TEST_SCOPE)
    for kind in cash.CASH_ACTIVITY_TYPES:
        a = rows.where(F.col("activity_type") == kind).agg(F.sum("usd")).first()[0] or 0.0
        b = weekly.agg(F.sum(kind)).first()[0]
        assert abs(a - b) < 1e-3 * max(1.0, abs(a))


def test_one_user_equals_all_users_filtered(spark):
    t = _t(spark)
    everyone = trades.trade_blotter(t, E.TEST_SCOPE)
    name = everyone.select("user_id").orderBy("user_id").first()[0]
    one = Scope(users=name, date_from="1995-01-01", date_to="2001-12-31")
    mine = trades.trade_blotter(t, one)
    assert mine.count() > 0
    assert mine.exceptAll(everyone.where(F.col("user_id") == name)).count() == 0
    assert everyone.where(F.col("user_id") == name).exceptAll(mine).count() == 0


def test_semi_join_equals_join_then_distinct(spark):
    t = _t(spark)
    semi = t.positions.join(
        t.order_legs.join(t.orders.select(F.col("id").alias("oid")), F.col("order_id") == F.col("oid"), "left_semi")
        .select(F.col("position_code").alias("pc")),
        F.col("code") == F.col("pc"),
        "left_semi",
    ).distinct()
    joined = (
        t.positions.join(t.order_legs, F.col("code") == F.col("position_code"))
        .join(t.orders.select(F.col("id").alias("oid")), F.col("order_id") == F.col("oid"))
        .select(*t.positions.columns)
        .distinct()
    )
    assert semi.exceptAll(joined).count() == 0 and joined.exceptAll(semi).count() == 0


def test_balances_usd_total_matches_balances(spark):
    t = _t(spark)
    bal = positions.account_balances(t, E.TEST_SCOPE)
    usdt = bal.where(F.col("symbol") == "USDT").agg(F.sum("balance")).first()[0] or 0.0
    usd = positions.balances_usd(t, E.TEST_SCOPE).agg(F.sum("usd")).first()[0]
    assert usd >= usdt - 1e-6
