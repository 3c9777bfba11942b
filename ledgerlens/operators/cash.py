"""Cash movements (U6) and their totals per period and type (U7)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.dates import day_start
from ledgerlens.functions.money import sum_in_order
from ledgerlens.functions.periods import period_label
from ledgerlens.functions.text import not_similar_or_null, not_similar_to_or_null, rtrim_chars
from ledgerlens.operators.rates import attach_usd_rate, fx_rates_for_join
from ledgerlens.plans.ordering import numbered
from ledgerlens.scope import Scope
from ledgerlens.sources.fixtures import Tables

# Activity types that move cash, in pivot column order.
CASH_ACTIVITY_TYPES = ("ADJUSTMENT", "DEPOSIT", "FINANCING", "WITHDRAWAL")
# Description fragments of internal movements (SIMILAR TO
# alternatives; ``_`` is any one character).
INTERNAL_DESCRIPTION_PATTERNS = ("demo", "Demo", "test_", "Test_", "hedge", "Hedge")
# Action codes containing this text are compensations.
COMPENSATION_MARK = "COMP"

CASH_COLUMNS = (
    "account_code",
    "activity_type",
    "transaction_time",
    "date_time",
    "user_id",
    "description",
    "quote_currency",
    "amount",
)


def cash_movement_rows(t: Tables, scope: Scope, internal: str | None = None, until: _dt.date | None = None) -> DataFrame:
    """Distinct cash legs before currency conversion (the SQL part of U6).

    ``internal``: a ``SIMILAR TO`` pattern of descriptions to leave out, in place of those
    that hold one of ``INTERNAL_DESCRIPTION_PATTERNS``.  ``until``: only what was created
    before that day.

    Activity, account and principal must exist, so those are inner joins; only
    the instrument may be missing.  The scope's principals come first: for a
    few users the accounts, activities and then legs that are joined are few.
    """
    said = F.col("description")
    outside = not_similar_or_null(said, INTERNAL_DESCRIPTION_PATTERNS) if internal is None else not_similar_to_or_null(said, internal)
    acts = t.activities.where(
        F.col("activity_type").isin(list(CASH_ACTIVITY_TYPES))
        & outside
        & ~F.col("action_code").contains(COMPENSATION_MARK)
        & (F.col("created_time") >= day_start(scope.first_day))
    )
    if until is not None:
        acts = acts.where(F.col("created_time") < day_start(until))
    acts = acts.select(
        F.col("id").alias("a_id"),
        F.col("account_id").alias("a_account"),
        "activity_type",
        "created_time",
        "description",
    )
    accts = t.accounts.where(F.col("clearing_code") == scope.clearing_code).select(
        F.col("id").alias("acc_id"), "account_code", F.col("owner_id").alias("acc_owner")
    )
    princ = scope.principals(t.principals).select(
        F.col("id").alias("p_id"), F.col("name").alias("user_id")
    )
    instr = t.instruments.select(F.col("id").alias("i_id"), F.col("symbol").alias("i_symbol"))
    legs = t.activity_legs.select("activity_id", "instrument_id", F.col("quantity").alias("amount"))

    rows = (
        princ.join(accts, F.col("acc_owner") == F.col("p_id"))
        .join(acts, F.col("a_account") == F.col("acc_id"))
        .join(legs, F.col("activity_id") == F.col("a_id"))
        .join(instr, F.col("instrument_id") == F.col("i_id"), "left")
    )
    return rows.select(
        "account_code",
        "activity_type",
        F.to_date("created_time").alias("transaction_time"),
        F.col("created_time").alias("date_time"),
        "user_id",
        "description",
        rtrim_chars(F.col("i_symbol"), "$").alias("quote_currency"),
        "amount",
    ).distinct()


def cash_movements(t: Tables, scope: Scope, ordered: bool = False, internal: str | None = None) -> DataFrame:
    """One row per distinct cash leg, with ``bid_price`` and ``usd`` (U6).

    ``transaction_time`` is the day (as a timestamp at midnight), ``date_time``
    the instant.  A currency without a rate on that day converts at 1.
    ``ordered=True`` adds ``row_no``, the rows' numbers in the source query's order,
    newest first (nulls before; ties by the other columns from left to right), through a
    table in the shared folder that holds the rows in that order.  ``internal``: see
    ``cash_movement_rows``.
    """
    rows = cash_movement_rows(t, scope, internal)
    rates = fx_rates_for_join(t.quotes_history, scope)
    out = attach_usd_rate(rows, rates, "transaction_time", "quote_currency")
    out = out.select(
        "account_code",
        "activity_type",
        F.col("transaction_time").cast("timestamp_ntz").alias("transaction_time"),
        "date_time",
        "user_id",
        "description",
        "quote_currency",
        "amount",
        "bid_price",
        (F.col("amount").cast("double") * F.col("bid_price")).alias("usd"),
    )
    if ordered:
        rest = [F.col(c).asc_nulls_last() for c in out.columns if c != "date_time"]
        out = numbered(out, [F.col("date_time").desc_nulls_first(), *rest]).orderBy("row_no")
    return out


def cash_movements_by_period(
    t: Tables, scope: Scope, activity_types: tuple[str, ...] = CASH_ACTIVITY_TYPES
) -> DataFrame:
    """USD totals per period label and activity type, one column per type (U7).

    Only periods with at least one movement appear; an absent type is 0.
    Amounts are summed as exact decimals per period and rate, partially before
    the shuffle; each sum is converted once.  A period has at most one rate per day
    and currency, and the products are added in the order of the rates.  So totals
    neither lose small amounts nor depend on the order of rows.
    """
    return _totals_by_period(cash_movements(t, scope), scope, activity_types)


def _totals_by_period(moves: DataFrame, scope: Scope, activity_types: tuple[str, ...]) -> DataFrame:
    """Of rows with ``transaction_time``, ``activity_type``, ``amount`` and ``bid_price``."""
    day = F.to_date("transaction_time")
    sums = [F.sum(F.when(F.col("activity_type") == a, F.col("amount"))).alias(a) for a in activity_types]
    label = period_label(day, scope.freq).alias("period")
    by_rate = moves.where(day.isNotNull()).groupBy(label, "bid_price").agg(*sums)
    usd = [(F.col(a).cast("double") * F.col("bid_price")).alias(a) for a in activity_types]
    by_rate = by_rate.select("period", "bid_price", *usd)
    totals = [F.coalesce(sum_in_order(F.col(a), "bid_price"), F.lit(0.0)).alias(a) for a in activity_types]
    return (
        by_rate.groupBy("period")
        .agg(*totals)
        .select(F.col("period").cast("timestamp_ntz").alias("transaction_time"), *activity_types)
    )


STATE_KEYS = ("transaction_time", "quote_currency", "activity_type")


def cash_totals_state(t: Tables, scope: Scope, until: _dt.date | None = None) -> DataFrame:
    """``(transaction_time, quote_currency, activity_type, amount)``: the exact sum of the
    scope's distinct cash legs per day, currency and type, created from ``scope.date_from``
    and before ``until``.  It needs no rates and no periods, so it can be written
    and kept; ``merge_totals`` adds states of other days, ``totals_from_state`` turns one
    into totals.

    A leg is counted once per state, so states to be merged must not share days.
    """
    legs = cash_movement_rows(t, scope, until=until).where(F.col("transaction_time").isNotNull())
    return _add_up(legs)


def _add_up(rows: DataFrame) -> DataFrame:
    # Wide enough for sums of sums; beyond 38 digits the cast raises under ANSI.
    exact = F.sum(F.col("amount").cast("decimal(38,6)")).cast("decimal(38,6)")
    return rows.groupBy(*STATE_KEYS).agg(exact.alias("amount"))


def merge_totals(*states: DataFrame) -> DataFrame:
    """One state of several, in any order: sums of exact decimals are associative.  Rows of
    equal keys are added up before the shuffle, and it grows with days, currencies and
    types only."""
    out = states[0]
    for s in states[1:]:
        out = out.unionByName(s)
    return _add_up(out)


def totals_from_state(
    state: DataFrame, quotes: DataFrame, scope: Scope, activity_types: tuple[str, ...] = CASH_ACTIVITY_TYPES
) -> DataFrame:
    """The same totals as ``cash_movements_by_period``, from a state."""
    priced = attach_usd_rate(state, fx_rates_for_join(quotes, scope), "transaction_time", "quote_currency")
    return _totals_by_period(priced, scope, activity_types)
