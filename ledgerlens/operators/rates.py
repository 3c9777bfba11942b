"""Daily currency rates to USD (U2) and the latest quote per symbol (U3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.dates import on_days
from ledgerlens.functions.ordering import NULL_TIME_LAST, order_key
from ledgerlens.functions.text import trim_chars
from ledgerlens.plans.joins import broadcast_if_bounded
from ledgerlens.scope import Scope

# Pairs quoted as USD per unit of the other currency.
QUOTED_IN_USD = ("BTC/USD", "ETH/USD", "EUR/USD", "GBP/USD")
# Pairs quoted as units of the other currency per USD (inverted).
USD_BASED = ("USD/JPY", "USD/CNH", "USD/MXN")
# Characters stripped from a pair to leave the currency code.
PAIR_TRIM_CHARS = "USD/|"
# Symbols whose latest quote prices crypto balances.
LAST_QUOTE_SYMBOLS = ("BTC/USD", "ETH/USD")

FX_PAIRS = QUOTED_IN_USD + USD_BASED
# Bytes per (date, currency, double) row, generously rounded up.
FX_ROW_BYTES = 64


def fx_daily_rates(quotes: DataFrame, scope: Scope) -> DataFrame:
    """One USD rate per (day, currency) for the listed pairs.

    Columns: ``transaction_time`` (date), ``quote_currency``, ``bid_price``
    (double, USD per unit).  Days run from ``scope.date_from`` to
    ``scope.today``.  Of several quotes on one day the earliest wins, ties
    broken by the lower raw price, so the result is deterministic.

    Written as a hash aggregate (``min_by`` over one packed ordering key)
    rather than a ``row_number`` window: the aggregate combines map-side, so a
    currency that holds a third of all ticks is reduced to one row per day
    and partition before the shuffle instead of being sorted in one task.
    """
    q = quotes.where(
        F.col("event_symbol").isin(list(FX_PAIRS))
        & on_days(F.col("bid_time"), scope.first_day, scope.last_rate_day)
    )
    raw = F.col("bid_price").cast("double")
    rate = F.when(F.col("event_symbol").isin(list(USD_BASED)), F.try_divide(F.lit(1.0), raw)).when(
        F.col("event_symbol").isin(list(QUOTED_IN_USD)), raw
    )
    return (
        q.select(
            F.to_date("bid_time").alias("transaction_time"),
            trim_chars(F.col("event_symbol"), PAIR_TRIM_CHARS).alias("quote_currency"),
            rate.alias("rate"),
            order_key(q, "bid_time", "bid_price").alias("k"),
        )
        .groupBy("transaction_time", "quote_currency")
        .agg(F.min_by("rate", "k").alias("bid_price"))
    )


def write_quotes_by_month(quotes: DataFrame, path: str) -> None:
    """Lay the quote history out by month of ``bid_time`` (``month=2024-01``; quotes without
    a time apart), for ``fx_rates_on_days``.  Rows go to one file per month and task,
    without a shuffle that a busy month could make uneven."""
    quotes.withColumn("month", F.date_format("bid_time", "yyyy-MM")).write.partitionBy("month").parquet(path)


def fx_rates_on_days(quotes: DataFrame, days: DataFrame, scope: Scope) -> DataFrame:
    """``fx_daily_rates`` of the days in the first column of ``days`` only (dates, in any
    number, repeated or null ones too) that lie in the scope's rate window.

    Where ``quotes`` is laid out by ``month``, only the months that hold such days are
    read: the days are broadcast, since the window bounds their number, and the scan is
    pruned by them when the query runs.
    """
    day = F.col(days.columns[0]).cast("date")
    wanted = days.select(day.alias("_day")).where(F.col("_day").between(F.lit(scope.first_day), F.lit(scope.last_rate_day)))
    wanted = broadcast_if_bounded(wanted.distinct().withColumn("_month", F.date_format("_day", "yyyy-MM")), scope.rate_days, FX_ROW_BYTES)
    on = F.to_date("bid_time") == F.col("_day")
    if "month" in quotes.columns:
        on = on & (F.col("month") == F.col("_month"))
    return fx_daily_rates(quotes.join(wanted, on, "left_semi"), scope)


def fx_rates_for_join(quotes: DataFrame, scope: Scope) -> DataFrame:
    """``fx_daily_rates`` marked for broadcast when its proven size allows.

    The rate table has at most (days in the window) x (listed pairs) rows,
    whatever the size of the quote history, so the bound is exact.
    """
    rates = fx_daily_rates(quotes, scope)
    return broadcast_if_bounded(rates, scope.rate_days * len(FX_PAIRS), FX_ROW_BYTES)


def attach_usd_rate(df: DataFrame, rates: DataFrame, day_col: str, ccy_col: str) -> DataFrame:
    """Left-join the daily rate as ``bid_price``; a missing rate counts as 1 USD.

    The rate table is unique per (day, currency), so the join never adds rows.
    """
    r = rates.select(
        F.col("transaction_time").alias("_fx_day"),
        F.col("quote_currency").alias("_fx_ccy"),
        F.col("bid_price").alias("_fx_rate"),
    )
    joined = df.join(r, (F.col(day_col) == F.col("_fx_day")) & (F.col(ccy_col) == F.col("_fx_ccy")), "left")
    return joined.select(*[F.col(c) for c in df.columns], F.coalesce(F.col("_fx_rate"), F.lit(1.0)).alias("bid_price"))


def latest_quotes(quotes: DataFrame, symbols: tuple[str, ...] = LAST_QUOTE_SYMBOLS) -> DataFrame:
    """Latest quote per symbol with the price kept as stored (decimal).

    "Latest" follows ``ORDER BY snapshot_time DESC`` with nulls first (a quote
    without a snapshot time ranks first); ties go to the higher price.  As a
    hash aggregate over one packed key it ships one row per symbol per
    partition through the shuffle, however hot the symbol is.
    """
    q = quotes.where(F.col("event_symbol").isin(list(symbols)))
    k = order_key(q, "snapshot_time", "bid_price", null_time=NULL_TIME_LAST)
    return q.groupBy("event_symbol").agg(
        F.max_by("snapshot_time", k).alias("snapshot_time"),
        F.max_by("bid_price", k).alias("bid_price"),
    )


def last_quote(quotes: DataFrame, symbols: tuple[str, ...] = LAST_QUOTE_SYMBOLS) -> DataFrame:
    """Latest quote per symbol: ``event_symbol, snapshot_time, bid_price`` (double)."""
    return latest_quotes(quotes, symbols).withColumn("bid_price", F.col("bid_price").cast("double"))
