"""One object per analysis scope, one method per report.

For callers used to configuring users, period and dates once and then asking
for each report in turn.  Every method returns a lazy DataFrame built by the
operators; nothing runs until the caller writes or collects it.

    reports = BrokerageReports(load_tables(spark, path), users=["alice"], date_from="2024-01-01")
    reports.cash_movements(by_period=True).show()
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ledgerlens.operators import cash, payloads, positions, rates, sessions, trades
from ledgerlens.scope import Scope
from ledgerlens.sources.fixtures import Tables


class BrokerageReports:
    def __init__(self, tables: Tables, scope: Scope | None = None, **scope_args) -> None:
        if scope is not None and scope_args:
            raise TypeError("pass either a Scope or scope arguments, not both")
        self.tables = tables
        self.scope = scope if scope is not None else Scope(**scope_args)

    # ---- rates ---------------------------------------------------------------
    def fx_rates(self) -> DataFrame:
        return rates.fx_daily_rates(self.tables.quotes_history, self.scope)

    def last_quotes(self, symbols: Sequence[str] = rates.LAST_QUOTE_SYMBOLS) -> DataFrame:
        return rates.last_quote(self.tables.quotes_history, tuple(symbols))

    # ---- activity --------------------------------------------------------------
    def login_sessions(self) -> DataFrame:
        return sessions.login_sessions(self.tables, self.scope)

    def trade_blotter(self, ordered: bool = False) -> DataFrame:
        return trades.trade_blotter(self.tables, self.scope, ordered=ordered)

    def cash_movements(self, by_period: bool = True, ordered: bool = False) -> DataFrame:
        """Totals per period and type (``by_period=True``), else one row per movement."""
        if by_period:
            return cash.cash_movements_by_period(self.tables, self.scope)
        return cash.cash_movements(self.tables, self.scope, ordered=ordered)

    # ---- holdings ----------------------------------------------------------------
    def open_positions(self) -> DataFrame:
        return positions.open_positions(self.tables, self.scope)

    def account_balances(self) -> DataFrame:
        return positions.account_balances(self.tables, self.scope)

    def balances_usd(self) -> DataFrame:
        return positions.balances_usd(self.tables, self.scope)

    # ---- payloads (tables of JSON documents) --------------------------------------
    def account_categories(self, clients: DataFrame, **kwargs) -> DataFrame:
        return payloads.account_categories(clients, clearing_code=self.scope.clearing_code, **kwargs)

    @staticmethod
    def account_metrics(documents: DataFrame, **kwargs) -> DataFrame:
        return payloads.account_metrics(documents, **kwargs)

    @staticmethod
    def payload_positions(documents: DataFrame, **kwargs) -> DataFrame:
        return payloads.payload_positions(documents, **kwargs)

    @staticmethod
    def payload_orders(documents: DataFrame, **kwargs) -> DataFrame:
        return payloads.payload_orders(documents, **kwargs)

    @staticmethod
    def profile_attributes(documents: DataFrame, **kwargs) -> DataFrame:
        return payloads.profile_attributes(documents, **kwargs)
