"""Sources: the brokerage tables, JSON payload tables and JDBC reads."""

from ledgerlens.sources.fixtures import Tables, load_tables

__all__ = ["Tables", "load_tables"]
