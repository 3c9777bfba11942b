"""The ten brokerage tables, derived from the driver's parquet tables.

Each view is a projection (plus at most one filter) over one driver table.
The projection is written once, as SQL expression text that both Spark
(``selectExpr``) and DuckDB accept, so the operators and the SQL oracle read
identical inputs.  Only the timestamp type name differs between the two
dialects; it is substituted for ``{ts}``.

Because each view is a plain projection, Catalyst pushes filters and column
pruning through it into the parquet scan: an operator that needs three
columns of ``orders`` reads three columns.

A deployment with real tables passes its own DataFrames to ``Tables``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# (source table, filter or None, [(column, expression), ...]) per view.
VIEWS: dict[str, tuple[str, str | None, list[tuple[str, str]]]] = {
    "principals": (
        "customer",
        None,
        [
            ("id", "c_custkey"),
            ("name", "CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_name END"),
            ("created_time", "cast(date '2023-01-01' + cast((c_custkey * 37) % 90 AS int) AS {ts})"),
        ],
    ),
    "accounts": (
        "customer",
        None,
        [
            ("id", "c_custkey"),
            ("account_code", "'A' || cast(c_custkey AS string)"),
            ("owner_id", "c_custkey - c_custkey % 2"),
            ("currency_id", "cast(c_nationkey AS bigint)"),
            ("clearing_code", "CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'DEMO' ELSE 'LIVE' END"),
        ],
    ),
    "instruments": (
        "part",
        None,
        [
            ("id", "p_partkey"),
            (
                "symbol",
                "CASE p_partkey % 12 WHEN 0 THEN 'BTC/USD' WHEN 1 THEN 'ETH/USD' WHEN 2 THEN 'EUR/USD' "
                "WHEN 3 THEN 'GBP/USD' WHEN 4 THEN 'USD/JPY' WHEN 5 THEN 'USD/CNH' WHEN 6 THEN 'USD/MXN' "
                "WHEN 7 THEN 'BTC/USDT' WHEN 8 THEN 'AAPL' WHEN 9 THEN 'BTC$' WHEN 10 THEN 'ETH' "
                "ELSE 'USDT$$' END",
            ),
            ("instrument_type", "p_type"),
            (
                "additional_fields",
                "'[{\"val\": \"' || CASE p_partkey % 5 WHEN 0 THEN 'Forex Majors' WHEN 1 THEN 'Forex Minors' "
                "WHEN 2 THEN 'Forex Metals' WHEN 3 THEN 'Indices' ELSE 'Crypto' END || '\"}]'",
            ),
        ],
    ),
    "activities": (
        "orders",
        None,
        [
            ("id", "o_orderkey"),
            ("account_id", "o_custkey"),
            ("order_id", "o_orderkey"),
            (
                "activity_type",
                "CASE o_orderpriority WHEN '1-URGENT' THEN 'TRADE' WHEN '2-HIGH' THEN 'DEPOSIT' "
                "WHEN '3-MEDIUM' THEN 'WITHDRAWAL' WHEN '4-NOT SPECIFIED' THEN 'ADJUSTMENT' "
                "WHEN '5-LOW' THEN 'FINANCING' END",
            ),
            ("created_time", "o_orderdate"),
            ("transaction_time", "o_orderdate"),
            (
                "description",
                "CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN 'demo credit' WHEN 2 THEN 'test_acct' "
                "WHEN 3 THEN 'wire in test' WHEN 4 THEN 'latest payout' WHEN 5 THEN 'Hedge rebalance' "
                "ELSE 'wire' END",
            ),
            ("action_code", "CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'X_COMP_1' ELSE 'CASH' END"),
            ("linked_position_code", "CASE WHEN o_orderkey % 3 = 0 THEN 'P' || cast(o_custkey AS string) END"),
        ],
    ),
    "activity_legs": (
        "lineitem",
        None,
        [
            ("activity_id", "l_orderkey"),
            ("instrument_id", "l_partkey"),
            ("quantity", "cast(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE -l_quantity END AS decimal(15,2))"),
            ("price", "cast(l_extendedprice AS decimal(15,2))"),
            ("leg_type", "CASE WHEN l_returnflag = 'A' THEN 'FEE' ELSE 'POS_ADJUST' END"),
            ("position_code", "cast(NULL AS string)"),
        ],
    ),
    "ord": (
        "orders",
        None,
        [
            ("id", "o_orderkey"),
            ("status", "CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'P' THEN 'REJECTED' END"),
            ("order_side", "CASE WHEN o_orderkey % 2 = 0 THEN 'BUY' ELSE 'SELL' END"),
            ("created_time", "o_orderdate"),
            ("transaction_time", "o_orderdate"),
            ("filled_quantity", "cast(cast(o_totalprice AS decimal(15,2)) / 1000 AS decimal(15,5))"),
            ("order_chain_id", "o_orderkey - o_orderkey % 3"),
            (
                "parameters",
                "CASE o_orderkey % 3 WHEN 0 THEN '{\"ORDER_EXEC_STRATEGY_NAME\": \"FX_STP\"}' "
                "WHEN 1 THEN '{\"ORDER_EXEC_STRATEGY_NAME\": \"MANUAL\"}' ELSE '{\"OTHER\": \"x\"}' END",
            ),
            (
                "extensions",
                # First what is not as it should be: no JSON, an object in place of the list,
                # slots that are no objects, values that are no numbers.
                "CASE WHEN o_orderkey % 40 = 1 THEN '[5, {\"val\": {\"PL_SETTLED_IN_TRADE_CURRENCY\": 2.25}}]' "
                "WHEN o_orderkey % 40 = 2 THEN '[{\"val\": 7}, null, {\"val\": {\"PL_SETTLED_IN_TRADE_CURRENCY\": \"n/a\", \"hedgingOrderId\": ' "
                "|| cast(o_orderkey - 2 AS string) || '}}]' "
                "WHEN o_orderkey % 40 = 3 THEN '{\"val\": {\"PL_SETTLED_IN_TRADE_CURRENCY\": 9}}' "
                "WHEN o_orderkey % 40 = 5 THEN '[{\"val\": {\"PL_SETT' "
                "ELSE CASE o_orderkey % 4 WHEN 0 THEN '[]' "
                "WHEN 1 THEN '[{\"val\": {\"PL_SETTLED_IN_TRADE_CURRENCY\": -1.5}}]' "
                "WHEN 2 THEN '[{\"x\": 1}, {\"val\": {\"PL_SETTLED_IN_TRADE_CURRENCY\": 2.25, \"hedgingOrderId\": ' "
                "|| cast(o_orderkey - 2 AS string) || '}}]' "
                "ELSE '[{\"val\": {\"hedgingOrderId\": ' || cast(o_orderkey - 3 AS string) || '}}]' END END",
            ),
        ],
    ),
    "order_legs": (
        "orders",
        None,
        [
            ("order_id", "o_orderkey"),
            ("position_code", "CASE WHEN o_orderkey % 6 = 5 THEN NULL ELSE cast(o_orderkey - o_orderkey % 3 AS string) END"),
            ("price", "cast(o_totalprice AS decimal(15,2))"),
            ("position_effect", "CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'OPEN' ELSE 'CLOSE' END"),
        ],
    ),
    "positions": (
        "lineitem",
        None,
        [
            ("account_id", "l_suppkey"),
            ("instrument_id", "l_partkey"),
            ("quantity", "cast(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE -l_quantity END AS decimal(15,2))"),
            ("cost", "cast(l_extendedprice AS decimal(15,2))"),
            ("code", "CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE cast(l_orderkey - l_orderkey % 3 AS string) END"),
            ("opening_time", "l_shipdate"),
        ],
    ),
    "user_sessions": (
        "events",
        None,
        [
            ("user_id", "user_id"),
            ("expire_at", "cast(date_trunc('day', ts) AS {ts})"),
        ],
    ),
    "quotes_history": (
        "orders",
        None,
        [
            (
                "event_symbol",
                "CASE o_orderkey % 8 WHEN 0 THEN 'BTC/USD' WHEN 1 THEN 'ETH/USD' WHEN 2 THEN 'EUR/USD' "
                "WHEN 3 THEN 'GBP/USD' WHEN 4 THEN 'USD/JPY' WHEN 5 THEN 'USD/CNH' WHEN 6 THEN 'USD/MXN' "
                "ELSE 'XRP/USD' END",
            ),
            ("bid_time", "o_orderdate"),
            ("snapshot_time", "o_orderdate"),
            ("bid_price", "cast(1 + cast(o_totalprice AS decimal(15,2)) / 100000 AS decimal(18,7))"),
        ],
    ),
}

SPARK_TS = "timestamp_ntz"
DUCKDB_TS = "TIMESTAMP"


def view_select(view: str, ts: str) -> str:
    """``SELECT ... FROM <driver table> [WHERE ...]`` text of one view."""
    source, where, cols = VIEWS[view]
    select = ", ".join(f"{expr.replace("{ts}", ts)} AS {name}" for name, expr in cols)
    sql = f"SELECT {select} FROM {source}"
    if where:
        sql += f" WHERE {where}"
    return sql


def oracle_with(*views: str) -> str:
    """A DuckDB ``WITH`` prefix defining the given views over the driver tables."""
    return "WITH " + ",\n".join(f"{v} AS ({view_select(v, DUCKDB_TS)})" for v in views) + "\n"


TABLE_NAMES = (
    "principals",
    "accounts",
    "instruments",
    "activities",
    "activity_legs",
    "orders",
    "order_legs",
    "positions",
    "user_sessions",
    "quotes_history",
)


class Tables:
    """The brokerage tables as DataFrames (``orders`` is the orders view).

    Each table is given either as a DataFrame or as a zero-argument callable
    returning one; callables are resolved on first use, so a query only
    touches the tables it reads.
    """

    def __init__(self, **frames: DataFrame | Callable[[], DataFrame]) -> None:
        missing = set(TABLE_NAMES) - set(frames)
        extra = set(frames) - set(TABLE_NAMES)
        if missing or extra:
            raise TypeError(f"Tables needs exactly {TABLE_NAMES}; missing {sorted(missing)}, extra {sorted(extra)}")
        self._frames = dict(frames)

    def __getattr__(self, name: str) -> DataFrame:
        frames = self.__dict__.get("_frames")
        if frames is None or name not in frames:
            raise AttributeError(name)
        value = frames[name]
        if not isinstance(value, DataFrame):
            value = value()
            frames[name] = value
        return value


def derive_view(spark: SparkSession, sf_dir: str, view: str) -> DataFrame:
    """One brokerage view over ``sf_dir``."""
    source, where, cols = VIEWS[view]
    df = spark.read.parquet(f"{sf_dir}/{source}.parquet")
    if where:
        df = df.where(where)
    return df.selectExpr(*[f"{expr.replace("{ts}", SPARK_TS)} AS {name}" for name, expr in cols])


def load_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The ten views over ``{sf_dir}/<table>.parquet``.  Lazy: nothing is read
    until an operator uses a table, and no job runs."""
    frames = {("orders" if v == "ord" else v): (lambda v=v: derive_view(spark, sf_dir, v)) for v in VIEWS}
    return Tables(**frames)


# Spark DDL of each table as the operators read it (all columns nullable).
SCHEMAS = {
    "principals": "id bigint, name string, created_time timestamp_ntz",
    "accounts": "id bigint, account_code string, owner_id bigint, currency_id bigint, clearing_code string",
    "instruments": "id bigint, symbol string, instrument_type string, additional_fields string",
    "activities": (
        "id bigint, account_id bigint, order_id bigint, activity_type string, created_time timestamp_ntz, "
        "transaction_time timestamp_ntz, description string, action_code string, linked_position_code string"
    ),
    "activity_legs": (
        "activity_id bigint, instrument_id bigint, quantity decimal(15,2), price decimal(15,2), "
        "leg_type string, position_code string"
    ),
    "orders": (
        "id bigint, status string, order_side string, created_time timestamp_ntz, transaction_time timestamp_ntz, "
        "filled_quantity decimal(15,5), order_chain_id bigint, parameters string, extensions string"
    ),
    "order_legs": "order_id bigint, position_code string, price decimal(15,2), position_effect string",
    "positions": (
        "account_id bigint, instrument_id bigint, quantity decimal(15,2), cost decimal(15,2), code string, "
        "opening_time timestamp_ntz"
    ),
    "user_sessions": "user_id bigint, expire_at timestamp_ntz",
    "quotes_history": "event_symbol string, bid_time timestamp_ntz, snapshot_time timestamp_ntz, bid_price decimal(18,7)",
}


def tables_from_rows(spark: SparkSession, **rows: list[tuple]) -> Tables:
    """Tables built from literal rows (tests, examples); unnamed tables are empty."""
    return Tables(**{n: spark.createDataFrame(rows.get(n, []), SCHEMAS[n]) for n in TABLE_NAMES})
