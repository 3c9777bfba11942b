"""Trade blotter in USD (U5): volume, PnL and markup per trade leg.

Shape of the plan
-----------------
* The scope comes first: activities meet the scope's accounts, and only orders of
  those activities go on.  With a list of users the ids of their orders are counted in a
  first pass; while they are few they are broadcast into the scans of orders and order
  legs, and so are the chain codes and hedge ids that these need
  (``plans.joins.carried_keys``), so that the rest of the order side is neither
  shuffled nor aggregated.
* ``orders.extensions`` is parsed once, to a variant; each of the four slots is read by
  itself, so a slot that is no object costs no other.  The source query's self-join of
  ``orders`` (only to compute a hedge id) becomes a column.
* The opening-order join (``order_legs.position_code = order_chain_id``)
  fans out over every completed order of the chain, yet all it contributes
  is whether the resolved strategy is the markup strategy, and only for legs
  whose own order names no strategy.  The chain side is pre-aggregated to two
  flags per chain (partial aggregation, so a hot chain is combined map-side)
  and each row is expanded into at most two, one per possible outcome.  After the
  final ``distinct`` this is the same set the fan-out produces.
* Hedge legs (order id and price) are looked up only for legs whose strategy is the
  markup strategy; other rows get a markup of 0 whatever the hedge.  Equal prices of
  one hedge order fall together in the final ``distinct``.
* Both lookups run on one row per activity and order leg, before activity legs and
  instruments are joined.  Rows that skip a lookup carry their activity id as a key that
  never matches, and the default hedge id 0, which markup legs without a hedge share, is
  split over salted keys with the legs of order 0 repeated for each
  (``plans.joins.lookup_join``).
* ``distinct`` runs on the raw selected columns (the four PnL slots included) before
  helpers are dropped, as the result is a set over exactly those columns.  The JSON
  text of ``parameters`` takes part by a 128-bit hash: it goes into no shuffle.
* Small dimensions (accounts, principals, instruments) are left to the
  planner: broadcast when their measured size is under the threshold, shuffled
  otherwise.  The rate table is broadcast behind its proven bound.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.dates import on_days
from ledgerlens.functions.text import text_after_slash
from ledgerlens.operators.rates import attach_usd_rate, fx_rates_for_join
from ledgerlens.plans.joins import carried_keys, lookup_join
from ledgerlens.plans.ordering import numbered
from ledgerlens.scope import Scope
from ledgerlens.sources.fixtures import Tables

# Whole-cell replacements applied to every text column of the
# blotter, in this order of statement.
LABEL_REPLACEMENTS = {
    "Forex Majors": "Forex",
    "Forex Minors": "Forex",
    "Forex Metals": "Forex",
    "Indices": "Equities",
    "MANUAL": "FX_STP",
}
# JSON keys and strategy names.
STRATEGY_KEY = "ORDER_EXEC_STRATEGY_NAME"
MARKUP_STRATEGY = "FX_STP"
DEFAULT_STRATEGY = "B_BOOK"
PNL_KEY = "PL_SETTLED_IN_TRADE_CURRENCY"
HEDGE_KEY = "hedgingOrderId"
TRADE_ACTIVITY = "TRADE"
POSITION_LEG = "POS_ADJUST"
COMPLETED = "COMPLETED"
# Extension slot (0-based) behind each PnL column name.
PNL_SLOTS = {"pnl_3": 0, "pnl_1": 1, "pnl_2": 2, "pnl_4": 3}
HEDGE_SLOTS = 4

# ``parameters_1``, ``parameters_2``: the JSON text by its hashes.
RAW_COLUMNS = (
    "user_id", "account_id", "order_symbol", "symbol", "pair_type", "order_side", "order_id",
    "created_time", "order_strategy", "parameters_1", "parameters_2", "position_code", "quantity",
    "transaction_time", "price", "pnl_3", "pnl_1", "pnl_2", "pnl_4", "markup", "position_effect",
)
OUTPUT_COLUMNS = (
    "user_id", "account_id", "order_symbol", "pair_type", "order_side", "order_id", "created_time",
    "position_code", "quantity", "transaction_time", "price", "markup", "position_effect",
    "order_strategy", "trade_time", "bid_price", "volume", "pnl",
)


def _strategy(parameters):
    return F.get_json_object(parameters, f"$.{STRATEGY_KEY}")


def _slot(ext: Column, i: int, key: str) -> Column:
    return F.try_variant_get(ext, f"$[{i}].val.{key}", "decimal(38,10)")


def _orders(orders: DataFrame) -> DataFrame:
    """Orders that count, with what their JSON says."""
    hedge = F.coalesce(*[_slot(F.col("ext"), i, HEDGE_KEY) for i in range(HEDGE_SLOTS)], F.lit(0).cast("decimal(38,10)"))
    text = F.col("parameters")
    rows = orders.where(F.col("status").isNull() | (F.col("status") == COMPLETED)).select(
        F.col("id").alias("o_id"),
        "order_side",
        F.col("created_time").alias("o_created"),
        "filled_quantity",
        _strategy(text).alias("own_strategy"),
        F.xxhash64(F.lit(1), text, text.isNull()).alias("parameters_1"),
        F.xxhash64(text, F.lit(2), text.isNull()).alias("parameters_2"),
        F.try_parse_json("extensions").alias("ext"),
    )
    return rows.select(
        *[c for c in rows.columns if c != "ext"],
        *[F.coalesce(_slot(F.col("ext"), i, PNL_KEY), F.lit(0).cast("decimal(38,10)")).alias(name) for name, i in PNL_SLOTS.items()],
        # Order ids are whole: any other number names no order.
        F.when(hedge == hedge.try_cast("bigint"), hedge.try_cast("bigint")).alias("hedge_id"),
    )


def _legs(order_legs: DataFrame) -> DataFrame:
    return order_legs.select(
        F.col("order_id").alias("ol_order"),
        F.col("position_code").alias("ol_code"),
        F.col("price").alias("ol_price"),
        F.col("position_effect").alias("ol_effect"),
    )


def extension_errors(orders: DataFrame) -> DataFrame:
    """``(order_id, path, problem, value)``: what ``orders.extensions`` holds that the
    blotter cannot read and counts as 0: a text that is no JSON, JSON that is no list, a
    slot or its ``val`` that is no object, a PnL or hedge id that is no number."""
    text = F.try_variant_get("ext", "$", "string")
    rows = orders.select(F.col("id").alias("order_id"), "extensions", F.try_parse_json("extensions").alias("ext")).where("extensions is not null")
    slots = F.try_variant_get("ext", "$", "array<variant>")

    def part(name: str) -> Column:
        return F.try_variant_get("ext", name, "variant")

    def error(path: str, problem: str, value: Column) -> Column:
        return F.struct(F.lit(path).alias("path"), F.lit(problem).alias("problem"), value.alias("value"))

    def shown(path: str) -> Column:
        return F.try_variant_get("ext", path, "string")

    def is_object(path: str) -> Column:
        return F.try_variant_get("ext", path, "map<string,variant>").isNotNull()

    found = [
        F.when(F.col("ext").isNull(), error("$", "no JSON", F.col("extensions"))),
        F.when(F.col("ext").isNotNull() & slots.isNull() & ~F.is_variant_null("ext"), error("$", "not a list", text)),
    ]
    for i in range(HEDGE_SLOTS):
        at = f"$[{i}]"
        found.append(F.when(part(at).isNotNull() & ~is_object(at), error(at, "not an object", shown(at))))
        found.append(F.when(part(f"{at}.val").isNotNull() & ~is_object(f"{at}.val"), error(f"{at}.val", "not an object", shown(f"{at}.val"))))
        for key in (PNL_KEY, HEDGE_KEY):
            path = f"{at}.val.{key}"
            bad = part(path).isNotNull() & ~F.is_variant_null(part(path)) & _slot(F.col("ext"), i, key).isNull()
            found.append(F.when(bad, error(path, "not a number", shown(path))))
    return rows.select("order_id", F.inline(F.array_compact(F.array(*found))))


def blotter_rows(t: Tables, scope: Scope, carry: bool | None = None) -> DataFrame:
    """The distinct raw rows of the blotter, before conversion to USD.

    ``carry``: whether to count, in two passes that run at once, the order ids in scope and
    the codes and hedge ids that they need, and to broadcast them where they are few; by
    default if the scope names its users.  The rows are the same."""
    carry = scope.users is not None if carry is None else carry

    # --- activities in scope ---
    acts = t.activities.where(
        (F.col("activity_type") == TRADE_ACTIVITY)
        & on_days(F.col("transaction_time"), scope.first_day, scope.last_trade_day + _dt.timedelta(days=1))
    ).select(
        F.col("id").alias("a_id"),
        F.col("account_id").alias("a_account"),
        F.col("order_id").alias("a_order"),
        F.col("transaction_time").alias("a_time"),
        F.col("linked_position_code").alias("a_linked"),
    )
    currencies = t.instruments.select(F.col("id").alias("cur_id"))
    princ = scope.principals(t.principals).select(F.col("id").alias("p_id"), F.col("name").alias("p_name"))
    accts = (
        t.accounts.where(
            (F.col("clearing_code") == scope.clearing_code) & ~F.col("id").isin(list(scope.trade_excluded_accounts))
        )
        .join(princ, F.col("owner_id") == F.col("p_id"))
        .join(currencies, F.col("currency_id") == F.col("cur_id"), "left_semi")
        .select(F.col("id").alias("acc_id"), "account_code", "p_name")
    )
    acts = acts.join(accts, F.col("a_account") == F.col("acc_id")).drop("a_account", "acc_id")

    # --- their orders and order legs ---
    orders, legs = t.orders, t.order_legs
    opening = t.orders.where(F.col("status") == COMPLETED).select(
        F.col("order_chain_id").cast("string").alias("chain_code"), _strategy(F.col("parameters")).alias("open_strategy")
    )
    hedges = t.order_legs.select(F.col("order_id").alias("h_order"), F.col("price").alias("h_price"))
    needs_chain = F.col("own_strategy").isNull() & F.col("ol_code").isNotNull()
    if carry and (ids := carried_keys(acts.select(F.col("a_order").alias("key")))) is not None:
        orders = orders.join(ids, F.col("id") == F.col("key"), "left_semi")
        legs = legs.join(ids, F.col("order_id") == F.col("key"), "left_semi")
        needed = _orders(orders).join(_legs(legs), F.col("o_id") == F.col("ol_order"))
        codes = carried_keys(needed.where(needs_chain).select(F.col("ol_code").alias("key")))
        if codes is not None:
            opening = opening.join(codes, F.col("chain_code") == F.col("key"), "left_semi")
        hedged = carried_keys(_orders(orders).select(F.col("hedge_id").alias("key")))
        if hedged is not None:
            hedges = hedges.join(hedged, F.col("h_order") == F.col("key"), "left_semi")
    rows = acts.join(_orders(orders), F.col("a_order") == F.col("o_id")).join(_legs(legs), F.col("o_id") == F.col("ol_order"))

    # --- strategy outcome: own order first, else the opening orders of the chain ---
    chains = opening.groupBy("chain_code").agg(
        F.bool_or(F.coalesce(F.col("open_strategy") == MARKUP_STRATEGY, F.lit(False))).alias("chain_fx"),
        F.bool_or(F.coalesce(F.col("open_strategy") != MARKUP_STRATEGY, F.lit(True))).alias("chain_other"),
    )
    rows = lookup_join(rows, chains, needs_chain, F.col("ol_code"), F.col("chain_code"), F.col("a_id").cast("string"))
    outcomes = (
        F.when(F.col("own_strategy").isNotNull(), F.array(F.col("own_strategy") == MARKUP_STRATEGY))
        .when(
            F.col("chain_fx").isNotNull(),
            F.array_compact(
                F.array(F.when(F.col("chain_fx"), F.lit(True)), F.when(F.col("chain_other"), F.lit(False)))
            ),
        )
        .otherwise(F.array(F.lit(DEFAULT_STRATEGY == MARKUP_STRATEGY)))
    )
    rows = rows.select("*", F.explode(outcomes).alias("is_fx")).drop("chain_code", "chain_fx", "chain_other")

    # --- hedge legs, looked up only where markup is computed ---
    hedged = F.col("is_fx") & F.col("hedge_id").isNotNull()
    rows = lookup_join(
        rows, hedges, hedged, F.col("hedge_id"), F.col("h_order"), F.col("a_id"), hot=F.lit(0)
    ).drop("h_order")

    # --- the activities' position legs ---
    alegs = t.activity_legs.where(F.col("leg_type") == POSITION_LEG).select(
        F.col("activity_id").alias("al_activity"),
        F.col("instrument_id").alias("al_instrument"),
        F.col("quantity").alias("al_quantity"),
        F.col("price").alias("al_price"),
        F.col("position_code").alias("al_code"),
    )
    instr = t.instruments.select(
        F.col("id").alias("i_id"),
        F.col("symbol").alias("i_symbol"),
        F.get_json_object(F.col("additional_fields"), "$[0].val").alias("i_pair_type"),
    )
    trades = rows.join(alegs, F.col("a_id") == F.col("al_activity")).join(instr, F.col("al_instrument") == F.col("i_id"))

    def exact(name: str, digits: int = 19):
        # Nine decimals: the product then keeps all of its 18 (20 + 17 + 1
        # digits) and is rounded once, whatever the tables' decimal types.
        return F.col(name).cast(f"decimal({digits},9)")

    markup = F.when(
        F.col("is_fx"),
        F.coalesce(
            F.round(F.abs((exact("al_price") - exact("h_price")) * exact("filled_quantity", 17)), 5),
            F.lit(0).cast("decimal(38,5)"),
        ),
    ).otherwise(F.lit(0).cast("decimal(38,5)"))

    return trades.select(
        F.col("p_name").alias("user_id"),
        F.col("account_code").alias("account_id"),
        F.col("i_symbol").alias("order_symbol"),
        F.split_part(F.col("i_symbol"), F.lit("/"), F.lit(2)).alias("symbol"),
        F.col("i_pair_type").alias("pair_type"),
        "order_side",
        F.col("a_order").alias("order_id"),
        F.col("o_created").alias("created_time"),
        # Read before the labels are replaced: a whole cell that is a label is no JSON.
        F.col("own_strategy").alias("order_strategy"),
        "parameters_1",
        "parameters_2",
        F.coalesce("ol_code", "al_code", "a_linked", F.lit("")).alias("position_code"),
        F.abs("al_quantity").alias("quantity"),
        F.col("a_time").alias("transaction_time"),
        F.col("ol_price").alias("price"),
        *PNL_SLOTS.keys(),
        markup.alias("markup"),
        F.coalesce("ol_effect", F.lit("")).alias("position_effect"),
    ).distinct()


def trade_blotter(t: Tables, scope: Scope, ordered: bool = False) -> DataFrame:
    """Trade rows with ``bid_price``, ``volume``, ``pnl`` and ``markup`` in USD.

    ``order_strategy`` is what the order parameters say and is not replaced, so a
    'MANUAL' strategy stays 'MANUAL' there while a cell holding exactly 'MANUAL'
    elsewhere becomes 'FX_STP'.  The quote currency
    is the text after '/' in the symbol ('USD' when absent, 'USDT' counted as
    'USD'); a missing daily rate converts at 1.  ``ordered=True`` adds ``row_no``, the
    rows' numbers in the source's ascending order of trade time (nulls last; ties by the
    other columns from left to right), through a table in the shared folder that holds the
    rows in that order.
    """
    raw = blotter_rows(t, scope)
    text_cols = [f.name for f in raw.schema.fields if f.dataType.typeName() == "string" and f.name != "order_strategy"]
    rows = raw.select(
        *[
            F.col(c).cast("double").alias(c)
            if c in ("quantity", "price", "markup", *PNL_SLOTS)
            else F.col(c)
            for c in RAW_COLUMNS
        ]
    ).replace(LABEL_REPLACEMENTS, subset=text_cols)

    ccy = F.coalesce(text_after_slash(F.col("order_symbol")), F.lit("USD"))
    rows = rows.select(
        "*",
        F.when(ccy == "USDT", F.lit("USD")).otherwise(ccy).alias("quote_currency"),
        F.col("transaction_time").alias("trade_time"),
        F.to_date("transaction_time").alias("trade_day"),
    )
    rates = fx_rates_for_join(t.quotes_history, scope)
    rows = attach_usd_rate(rows, rates, "trade_day", "quote_currency")
    b = F.col("bid_price")
    out = rows.select(
        "user_id", "account_id", "order_symbol", "pair_type", "order_side", "order_id", "created_time",
        "position_code", "quantity",
        F.col("trade_day").cast("timestamp_ntz").alias("transaction_time"),
        "price",
        (F.col("markup") * b).alias("markup"),
        "position_effect", "order_strategy", "trade_time", "bid_price",
        (F.col("quantity") * F.col("price") * b).alias("volume"),
        ((F.col("pnl_1") + F.col("pnl_2") + F.col("pnl_3") + F.col("pnl_4")) * b).alias("pnl"),
    )
    if ordered:
        rest = [F.col(c).asc_nulls_last() for c in OUTPUT_COLUMNS if c != "trade_time"]
        out = numbered(out, [F.col("trade_time").asc_nulls_last(), *rest]).orderBy("row_no")
    return out
