"""Open positions (U8) and client balances in USD (U9)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.text import rtrim_chars
from ledgerlens.operators.rates import latest_quotes
from ledgerlens.plans.joins import broadcast_if_bounded, carried_keys
from ledgerlens.plans.ordering import numbered
from ledgerlens.scope import Scope
from ledgerlens.sources.fixtures import Tables

# Balance symbol -> quote symbol used to price it in USD;
# a symbol priced at exactly 1 USD; everything else counts as 0 USD.
CRYPTO_QUOTES = {"BTC": "BTC/USD", "ETH": "ETH/USD"}
USD_PEGGED = "USDT"


def _open_rows(t: Tables, scope: Scope, carry: bool | None = None) -> DataFrame:
    """Distinct open positions in scope.

    Order legs and orders only have to exist for a position's code: a semi join against
    the distinct codes of all legs that have an order.  With a list of users (or
    ``carry``) the scope's codes are counted in a pass that runs at once; while they are
    few, they are broadcast into the scan of the order legs, and those found into the scan
    of the positions, so that neither table is shuffled by code.
    """
    carry = scope.users is not None if carry is None else carry
    pos = t.positions.where(F.col("code").isNotNull() & (F.col("quantity") != 0))
    instr = t.instruments.select(F.col("id").alias("i_id"), F.col("symbol").alias("i_symbol"), "instrument_type")
    accts = t.accounts.select(F.col("id").alias("acc_id"), "account_code", F.col("owner_id").alias("acc_owner"))
    princ = scope.principals(t.principals).select(F.col("id").alias("p_id"), "name")
    owned = princ.join(accts, F.col("acc_owner") == F.col("p_id")).join(pos, F.col("account_id") == F.col("acc_id"))
    held = owned.join(instr, F.col("instrument_id") == F.col("i_id")).select(
        F.col("name").alias("user_id"),
        "account_code",
        F.col("i_symbol").alias("order_symbol"),
        "quantity",
        "cost",
        F.col("code").alias("position_code"),
        "opening_time",
        F.col("i_id").alias("symbol"),
        "instrument_type",
    )
    legs = t.order_legs.where(F.col("position_code").isNotNull())
    codes = carried_keys(owned.select(F.col("code").alias("key"))) if carry else None
    if codes is not None:
        legs = legs.join(codes, F.col("position_code") == F.col("key"), "left_semi")
    existing_orders = t.orders.select(F.col("id").alias("o_id"))
    found = (
        legs.join(existing_orders, F.col("order_id") == F.col("o_id"), "left_semi")
        .select(F.col("position_code").alias("leg_code"))
        .distinct()
    )
    if codes is not None:
        found = F.broadcast(found)  # no more than the carried codes
    return held.join(found, F.col("position_code") == F.col("leg_code"), "left_semi").distinct()


def open_position_codes(t: Tables, scope: Scope) -> DataFrame:
    """The distinct ``(user_id, order_symbol, position_code)`` of open positions,
    one row per code: for pairs with more codes than one array should hold."""
    rows = _open_rows(t, scope).where(F.col("order_symbol").isNotNull())
    return rows.select("user_id", "order_symbol", "position_code").distinct()


def open_position_code_chunks(t: Tables, scope: Scope, most: int = 1000) -> DataFrame:
    """``(user_id, order_symbol, chunk, position_codes)``: the distinct codes of each pair
    in order, in arrays of ``most`` (the last chunk: what is left), numbered from 0.

    No pair is one row or one task: codes are numbered in ranges of (user, symbol, code)
    (``plans.ordering``), a code's place in its pair is its number less the pair's first,
    and only the codes of a chunk meet in one group.
    """
    codes = open_position_codes(t, scope)
    pair = ["user_id", "order_symbol"]
    rows = numbered(codes, [F.col(c).asc_nulls_first() for c in (*pair, "position_code")])
    first = rows.groupBy(*pair).agg(F.min("row_no").alias("first"))
    # Principals in scope and symbols of open positions are not null.
    placed = rows.join(first, pair).withColumn("chunk", F.floor((F.col("row_no") - F.col("first")) / most).cast("long"))
    chunks = placed.groupBy(*pair, "chunk").agg(F.array_sort(F.collect_list("position_code")).alias("position_codes"))
    return chunks.select(*pair, "chunk", "position_codes")


def open_positions(t: Tables, scope: Scope) -> DataFrame:
    """Per ``(user_id, order_symbol)``: summed quantity and cost, the sorted distinct
    position codes, ``open_price = cost / quantity`` (null when the net quantity is 0)
    and the ``date`` stamp (``scope.as_of``, else now).

    Rows are de-duplicated over the selected columns before summing, then
    summed as decimals and cast to double, so totals do not depend on order.
    The array ``position_code`` holds all codes of a pair, so it suits pairs whose codes
    fit a row; ``open_position_codes`` has them as rows, ``open_position_code_chunks`` in
    bounded arrays.
    """
    rows = _open_rows(t, scope)
    as_of = F.lit(scope.as_of).cast("timestamp_ntz") if scope.as_of else F.localtimestamp()
    # Groups follow pandas: a null key forms no group.
    grouped = rows.where(F.col("order_symbol").isNotNull()).groupBy("user_id", "order_symbol").agg(
        F.sum("quantity").cast("double").alias("quantity"),
        F.sum("cost").cast("double").alias("cost"),
        F.array_sort(F.collect_set("position_code")).alias("position_code"),
    )
    return grouped.select(
        "user_id",
        "order_symbol",
        "quantity",
        "cost",
        "position_code",
        F.try_divide(F.col("cost"), F.when(F.col("quantity") != 0, F.col("quantity"))).alias("open_price"),
        as_of.alias("date"),
    )


def _balance_groups(t: Tables, scope: Scope) -> DataFrame:
    """Positive, code-less holdings summed per account, principal and raw
    symbol; the symbol is trimmed of trailing '$' after grouping.  The
    balance stays an exact decimal.

    Positions are first summed per (account, instrument) -- map-side, before
    any shuffle -- and only those totals meet the account, principal and
    instrument tables.  A sum distributes over these joins (a duplicated
    dimension row multiplies a total exactly as it multiplies its rows), so
    the result is the same while the join input shrinks to one row per
    holding.
    """
    pos = (
        t.positions.where(
            F.col("code").isNull()
            & ~F.col("account_id").isin(list(scope.balance_excluded_accounts))
            & (F.col("quantity") > 0)
        )
        .groupBy("account_id", "instrument_id")
        .agg(F.sum("quantity").alias("quantity"))
    )
    accts = t.accounts.where(F.col("clearing_code").isin([scope.clearing_code])).select(
        F.col("id").alias("acc_id"), "account_code", F.col("owner_id").alias("acc_owner")
    )
    princ = scope.principals(t.principals).select(F.col("id").alias("p_id"), "name")
    instr = t.instruments.select(F.col("id").alias("i_id"), F.col("symbol").alias("raw_symbol"))
    return (
        pos.join(accts, F.col("account_id") == F.col("acc_id"))
        .join(princ, F.col("acc_owner") == F.col("p_id"))
        .join(instr, F.col("instrument_id") == F.col("i_id"))
        .groupBy("account_code", "name", "raw_symbol")
        .agg(F.sum("quantity").alias("balance"))
        .select(
            rtrim_chars(F.col("raw_symbol"), "$").alias("symbol"),
            F.col("name").alias("user_id"),
            "account_code",
            "balance",
        )
    )


def account_balances(t: Tables, scope: Scope) -> DataFrame:
    """Balances per account and symbol (U9, SQL part).

    Grouped by the *raw* symbol and trimmed of trailing '$' afterwards, so
    'USDT' and 'USDT$$' stay separate rows that both read 'USDT'.
    Columns: ``symbol, user_id, account_code, balance`` (double).
    """
    return _balance_groups(t, scope).withColumn("balance", F.col("balance").cast("double"))


def balances_usd(t: Tables, scope: Scope) -> DataFrame:
    """USD value of each user's balances: BTC and ETH at their latest quote,
    USDT at 1, every other symbol at 0.  Columns ``user_id, usd``.

    Prices come from the latest-quote operator; that table has at most one row
    per listed symbol, so it is broadcast on that bound.  Balances are summed as
    exact decimals per user and symbol, multiplied once by the price (as doubles),
    and the terms are added in a fixed order: BTC, ETH, USDT.
    """
    quotes = latest_quotes(t.quotes_history, tuple(CRYPTO_QUOTES.values()))
    mapping = F.create_map(*[x for k, v in CRYPTO_QUOTES.items() for x in (F.lit(v), F.lit(k))])
    prices = quotes.select(mapping[F.col("event_symbol")].alias("q_symbol"), F.col("bid_price").cast("double").alias("q_price"))
    prices = broadcast_if_bounded(prices, len(CRYPTO_QUOTES), 64)
    priced = _balance_groups(t, scope).join(prices, F.col("symbol") == F.col("q_symbol"), "left")
    held = {c: F.sum(F.when(F.col("symbol") == c, F.col("balance"))).cast("double") for c in (*CRYPTO_QUOTES, USD_PEGGED)}
    terms = [held[c] * F.max(F.when(F.col("symbol") == c, F.col("q_price"))) for c in CRYPTO_QUOTES] + [held[USD_PEGGED]]
    usd = F.lit(0.0)
    for term in terms:
        usd = usd + F.coalesce(term, F.lit(0.0))
    return priced.groupBy("user_id").agg(usd.alias("usd"))
