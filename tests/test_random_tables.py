"""Differential test: random driver-shaped tables, every query vs its SQL.

The driver's tables have no nulls and few odd values; these tables add null
names, dates, statuses, quantities and types, repeated line numbers and
far-apart dates, then every registered query must still equal its DuckDB
statement.  Keys that the brokerage schema treats as identifiers (customer,
part and order keys) stay unique.
"""

import datetime as dt
import os

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as E
from tools_compare import digest

SEGMENTS = ["HOUSEHOLD", "MACHINERY", "BUILDING", "AUTOMOBILE", "FURNITURE"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _maybe_null(rng, values, p):
    return [None if rng.random() < p else v for v in values]


def _write(dirname, name, columns):
    pq.write_table(pa.table(columns), os.path.join(dirname, f"{name}.parquet"))


def make_tables(dirname, seed):
    rng = np.random.default_rng(seed)
    n_c, n_p, n_o, n_l, n_e = 60, 40, 400, 1500, 300
    base = dt.datetime(1995, 1, 1)

    def day(i):
        return base + dt.timedelta(days=int(i))

    custkeys = rng.permutation(np.arange(n_c * 2))[:n_c]
    _write(dirname, "customer", {
        "c_custkey": pa.array(custkeys.astype("int64")),
        "c_name": pa.array(_maybe_null(rng, [f"Customer#{k:09d}" for k in custkeys], 0.1)),
        "c_nationkey": pa.array(_maybe_null(rng, [int(x) for x in rng.integers(0, 25, n_c)], 0.05), pa.int32()),
        "c_acctbal": pa.array(np.round(rng.uniform(-999, 9999, n_c), 2)),
        "c_mktsegment": pa.array(_maybe_null(rng, list(rng.choice(SEGMENTS, n_c)), 0.05)),
    })
    partkeys = np.arange(n_p)
    _write(dirname, "part", {
        "p_partkey": pa.array(partkeys.astype("int64")),
        "p_name": pa.array([f"part {k}" for k in partkeys]),
        "p_brand": pa.array([f"Brand#{k % 5}" for k in partkeys]),
        "p_type": pa.array(_maybe_null(rng, list(rng.choice(["ECONOMY", "STANDARD", "PROMO"], n_p)), 0.1)),
        "p_size": pa.array(rng.integers(1, 50, n_p).astype("int32")),
        "p_retailprice": pa.array(np.round(rng.uniform(900, 2000, n_p), 2)),
    })
    orderkeys = rng.permutation(np.arange(n_o * 3))[:n_o]
    dates = [day(i) for i in rng.integers(0, 2600, n_o)]
    _write(dirname, "orders", {
        "o_orderkey": pa.array(orderkeys.astype("int64")),
        "o_custkey": pa.array(_maybe_null(rng, [int(x) for x in rng.choice(custkeys, n_o)], 0.03), pa.int64()),
        "o_orderstatus": pa.array(_maybe_null(rng, list(rng.choice(["F", "O", "P"], n_o)), 0.05)),
        "o_totalprice": pa.array(_maybe_null(rng, list(np.round(rng.uniform(100, 500000, n_o), 2)), 0.03),
                                 pa.float64()),
        "o_orderdate": pa.array(_maybe_null(rng, dates, 0.03), pa.timestamp("us")),
        "o_orderpriority": pa.array(_maybe_null(rng, list(rng.choice(PRIORITIES, n_o)), 0.03)),
    })
    _write(dirname, "lineitem", {
        "l_orderkey": pa.array(rng.choice(orderkeys, n_l).astype("int64")),
        "l_partkey": pa.array(_maybe_null(rng, [int(x) for x in rng.integers(0, n_p + 3, n_l)], 0.03), pa.int64()),
        "l_suppkey": pa.array(rng.choice(custkeys, n_l).astype("int64")),
        "l_linenumber": pa.array(rng.integers(1, 5, n_l).astype("int32")),
        "l_quantity": pa.array(_maybe_null(rng, list(rng.integers(0, 50, n_l).astype(float)), 0.03),
                               pa.float64()),
        "l_extendedprice": pa.array(np.round(rng.uniform(1, 90000, n_l), 2)),
        "l_discount": pa.array(np.round(rng.uniform(0, 0.1, n_l), 2)),
        "l_tax": pa.array(np.round(rng.uniform(0, 0.08, n_l), 2)),
        "l_returnflag": pa.array(list(rng.choice(["A", "N", "R"], n_l))),
        "l_linestatus": pa.array(list(rng.choice(["F", "O"], n_l))),
        "l_shipdate": pa.array([day(i) for i in rng.integers(0, 2600, n_l)], pa.timestamp("us")),
    })
    ts = [dt.datetime(2024, 1, 1) + dt.timedelta(seconds=int(s)) for s in rng.integers(0, 30 * 86400, n_e)]
    _write(dirname, "events", {
        "event_id": pa.array(np.arange(n_e).astype("int64")),
        "ts": pa.array(ts, pa.timestamp("us")),
        "user_id": pa.array(rng.choice(custkeys, n_e).astype("int64")),
        "event_type": pa.array(["click"] * n_e),
        "value": pa.array(np.round(rng.uniform(0, 20, n_e), 2)),
        "props": pa.array(["{}"] * n_e),
    })


@pytest.fixture(scope="module", params=[7, 11, 23])
def random_dir(request, tmp_path_factory):
    d = str(tmp_path_factory.mktemp(f"tables-{request.param}"))
    make_tables(d, request.param)
    return d


def test_every_query_matches_sql_on_random_tables(spark, random_dir):
    import duckdb

    con = duckdb.connect()
    for t in ("customer", "part", "orders", "lineitem", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{random_dir}/{t}.parquet'")
    sql = E.oracle_sql()
    bad = []
    for name, fn in E.queries().items():
        if E.corpus and (name in E.corpus.queries() or name == "pipeline"):
            continue
        got = digest(fn(spark, random_dir).toPandas())
        want = digest(con.execute(sql[name]).df())
        if got != want:
            bad.append((name, got[0], want[0]))
    assert not bad


def test_scoped_queries_match_sql_on_random_tables(spark, random_dir):
    import datetime as _dt

    import duckdb

    from dataclasses import replace

    from ledgerlens import sqlcheck
    from ledgerlens.functions.periods import SUPPORTED_FREQS
    from ledgerlens.operators import cash, positions, rates, sessions, trades
    from ledgerlens.scope import Scope
    from ledgerlens.sources.fixtures import load_tables

    con = duckdb.connect()
    for t in ("customer", "part", "orders", "lineitem", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{random_dir}/{t}.parquet'")
    names = [r[0] for r in con.execute(
        "SELECT c_name FROM customer WHERE c_name IS NOT NULL ORDER BY c_custkey LIMIT 12").fetchall()]
    rng = np.random.default_rng(len(random_dir))
    lo = _dt.date(1995, 1, 1) + _dt.timedelta(days=int(rng.integers(0, 900)))
    hi = lo + _dt.timedelta(days=int(rng.integers(30, 1500)))
    users = list(rng.choice(names, 5, replace=False))
    scope = Scope(users=users, date_from=lo.isoformat(), date_to=hi.isoformat(), today="2001-06-30",
                  as_of="2024-01-01 00:00:00")
    t = load_tables(spark, random_dir)
    pairs = {
        "fx": (rates.fx_daily_rates(t.quotes_history, scope), sqlcheck.fx_daily_rates(scope)),
        "cash": (cash.cash_movements(t, scope), sqlcheck.cash_movements(scope)),
        **{
            f: (cash.cash_movements_by_period(t, replace(scope, freq=f)), sqlcheck.cash_movements_by_period(replace(scope, freq=f)))
            for f in SUPPORTED_FREQS
        },
        "trades": (trades.trade_blotter(t, scope), sqlcheck.trade_blotter(scope)),
        "sessions": (sessions.login_sessions(t, scope), sqlcheck.login_sessions(scope)),
        "positions": (positions.open_positions(t, scope), sqlcheck.open_positions(scope, scope.as_of)),
        "balances": (positions.account_balances(t, scope), sqlcheck.account_balances(scope)),
        "usd": (positions.balances_usd(t, scope), sqlcheck.balances_usd(scope)),
    }
    bad = [k for k, (df, sql) in pairs.items() if digest(df.toPandas()) != digest(con.execute(sql).df())]
    assert not bad, (scope, bad)
