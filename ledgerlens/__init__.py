"""ledgerlens: brokerage analytics as lazy Spark DataFrame operators.

Operators are pure functions ``(tables, scope) -> DataFrame``.  None of them
triggers a Spark action; the caller decides whether to write, count or show.
"""

from ledgerlens.reports import BrokerageReports
from ledgerlens.scope import Scope
from ledgerlens.session import configure_session, get_session
from ledgerlens.sources.fixtures import Tables, load_tables

__all__ = ["BrokerageReports", "Scope", "Tables", "configure_session", "get_session", "load_tables"]
