import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from ledgerlens.operators.payloads import maps_as_json
from ledgerlens.reports import BrokerageReports
from ledgerlens.scope import Scope
from ledgerlens.sources import payloads as docs
from tests.conftest import SF_SMALL
from tools_compare import digest


def test_reports_equal_registered_queries(spark):
    r = BrokerageReports(E._tables(spark, SF_SMALL), E.TEST_SCOPE)
    q = E.queries()
    pairs = {
        "fx_daily_rates": r.fx_rates(),
        "last_quote": r.last_quotes(),
        "login_sessions": r.login_sessions(),
        "trade_blotter": r.trade_blotter(),
        "cash_movements": r.cash_movements(by_period=False),
        "cash_movements_weekly": r.cash_movements(),
        "open_positions": r.open_positions(),
        "account_balances": r.account_balances(),
        "balances_usd": r.balances_usd(),
        "account_categories": r.account_categories(docs.client_payloads(spark, SF_SMALL)),
        "account_metrics": r.account_metrics(docs.metrics_payloads(spark, SF_SMALL)),
    }
    for name, df in pairs.items():
        df = maps_as_json(df)
        assert digest(df.toPandas()) == digest(q[name](spark, SF_SMALL).toPandas()), name


def test_reports_scope_arguments(spark):
    r = BrokerageReports(E._tables(spark, SF_SMALL), users="Customer#000000003", freq="MS")
    assert r.scope == Scope(users="Customer#000000003", freq="MS")
    with pytest.raises(TypeError):
        BrokerageReports(E._tables(spark, SF_SMALL), Scope(), users="x")


def test_registered_open_positions_hold_their_codes(spark):
    q = E.queries()
    held = q["open_positions"](spark, SF_SMALL).select("user_id", "order_symbol", F.explode("position_code"))
    codes = [tuple(r) for r in q["open_position_codes"](spark, SF_SMALL).collect()]
    assert codes and sorted(map(tuple, held.collect())) == sorted(codes)
    assert "position_code" in E.oracle_sql()["open_positions"] and "EXCLUDE" not in E.oracle_sql()["open_positions"]
