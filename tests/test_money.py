"""Money on wide decimals: small amounts count, and sums are exact."""

from decimal import Decimal as D

from pyspark.sql import functions as F

from ledgerlens.functions.ordering import order_key
from ledgerlens.functions.periods import SUPPORTED_FREQS, period_label, period_label_sql
from ledgerlens.operators import cash, positions, rates
from ledgerlens.scope import Scope
from ledgerlens.sources.fixtures import TABLE_NAMES, Tables, tables_from_rows
from tests.test_edges import T

WIDE = "decimal(38,18)"
SCOPE = Scope(date_from="2024-01-01", today="2024-02-01")


def with_table(t, **frames):
    return Tables(**{n: frames.get(n, getattr(t, n)) for n in TABLE_NAMES})


def base(spark):
    return tables_from_rows(
        spark,
        principals=[(1, "alice", T(2024, 1, 1))],
        accounts=[(10, "A10", 1, 100, "LIVE")],
        instruments=[(100, "BTC", "CRYPTO", None), (101, "EUR$", "FX", None)],
        quotes_history=[("BTC/USD", T(2024, 1, 2), T(2024, 1, 2), D("60000"))],
    )


def test_small_balance(spark):
    held = spark.createDataFrame([(10, 100, D("0.004"), D("1"), None, T(2024, 1, 1))], f"account_id long, instrument_id long, quantity {WIDE}, cost {WIDE}, code string, opening_time timestamp_ntz")
    t = with_table(base(spark), positions=held)
    assert [r.usd for r in positions.balances_usd(t, SCOPE).collect()] == [240.0]


def test_many_small_movements(spark):
    t = base(spark)
    acts = spark.range(1_000_000).select(
        "id", F.lit(10).cast("long").alias("account_id"), F.lit(None).cast("long").alias("order_id"), F.lit("DEPOSIT").alias("activity_type"),
        F.expr("timestamp_ntz'2024-01-02 00:00:00' + make_dt_interval(0, 0, 0, id / 100)").alias("created_time"),
        F.lit(None).cast("timestamp_ntz").alias("transaction_time"), F.lit(None).cast("string").alias("description"),
        F.lit("CASH").alias("action_code"), F.lit(None).cast("string").alias("linked_position_code"),
    )
    legs = spark.range(1_000_000).select(
        F.col("id").alias("activity_id"), F.lit(101).cast("long").alias("instrument_id"), F.lit("0.0000004").cast(WIDE).alias("quantity"),
        F.lit(None).cast(WIDE).alias("price"), F.lit("CASH").alias("leg_type"), F.lit(None).cast("string").alias("position_code"),
    )
    out = cash.cash_movements_by_period(with_table(t, activities=acts, activity_legs=legs), SCOPE).collect()
    assert [r.DEPOSIT for r in out] == [0.4]


def test_wide_prices_order_exactly(spark):
    rows = [("BTC/USD", T(2024, 1, 2), T(2024, 1, 2), D("123456789012345.000000001")), ("BTC/USD", T(2024, 1, 2), T(2024, 1, 2), D("123456789012345.000000002"))]
    q = spark.createDataFrame(rows, f"event_symbol string, bid_time timestamp_ntz, snapshot_time timestamp_ntz, bid_price {WIDE}")
    assert rates.latest_quotes(q).first().bid_price == D("123456789012345.000000002")
    keys = q.select(order_key(q, "bid_time", "bid_price").alias("k")).distinct()
    assert keys.count() == 2


def test_period_labels_equal_sql(spark, duck):
    days = spark.range(800).select(F.expr("date_add(date'2023-06-15', cast(id as int))").alias("d"))
    for freq in SUPPORTED_FREQS:
        got = {tuple(r) for r in days.select("d", period_label(F.col("d"), freq)).collect()}
        label = period_label_sql("d", freq)
        want = set(duck.execute(f"SELECT d, {label} FROM (SELECT DATE '2023-06-15' + CAST(i AS INTEGER) AS d FROM range(800) t(i))").fetchall())
        assert got == want, freq
