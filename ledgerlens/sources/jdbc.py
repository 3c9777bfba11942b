"""Relational sources read over JDBC (the brokerage tables live in
PostgreSQL in production).

Reads are split across executors by a numeric column range
(``partitionColumn`` / ``lowerBound`` / ``upperBound`` / ``numPartitions``),
and filters written on the returned DataFrame are pushed into the remote
query by Spark's JDBC source (they show as ``PushedFilters`` in the plan).
Credentials are passed in by the caller; nothing is read from files here.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.sources.fixtures import Tables

# Table name inside the trading schema for each ``Tables`` field.
TRADING_TABLES = {
    "principals": "principals",
    "accounts": "accounts",
    "instruments": "instruments",
    "activities": "activities",
    "activity_legs": "activity_legs",
    "orders": "orders",
    "order_legs": "order_legs",
    "positions": "positions",
    "user_sessions": "user_sessions",
    "quotes_history": "quotes_history",
}


# Tables that grow with the business; read by one task, they would not end.
LARGE_TABLES = ("activities", "activity_legs", "orders", "order_legs", "positions", "user_sessions", "quotes_history")


def jdbc_options(
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options for ``spark.read.format('jdbc')``.  A partitioned read needs all
    of column, bounds and partition count; a partial set is rejected rather
    than silently read by one task."""
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    part = (partition_column, lower_bound, upper_bound, num_partitions)
    if any(p is not None for p in part):
        if any(p is None for p in part):
            raise ValueError("partitioned JDBC read needs partition_column, bounds and num_partitions")
        opts.update(
            partitionColumn=str(partition_column),
            lowerBound=str(lower_bound),
            upperBound=str(upper_bound),
            numPartitions=str(num_partitions),
        )
    return opts


def read_jdbc(spark: SparkSession, **kwargs) -> DataFrame:
    """One table over JDBC; see ``jdbc_options`` for the arguments."""
    return spark.read.format("jdbc").options(**jdbc_options(**kwargs)).load()


def load_jdbc_tables(
    spark: SparkSession,
    url: str,
    schema: str,
    properties: Mapping[str, str] | None = None,
    partitioning: Mapping[str, tuple[str, int, int, int]] | None = None,
) -> Tables:
    """All brokerage tables from one database schema.

    ``partitioning`` maps a ``Tables`` field to ``(column, lower, upper,
    partitions)`` and must name every large table; small ones are read by one
    task each.  A table's schema is asked for when it is first used.
    """
    props = dict(properties or {})
    parts = dict(partitioning or {})
    missing = [f for f in LARGE_TABLES if f not in parts]
    if missing:
        raise ValueError(f"partitioning must name {missing}: one task would read each of them")
    frames = {}
    for field, table in TRADING_TABLES.items():
        kw = dict(url=url, table=f"{schema}.{table}", **props)
        if field in parts:
            col, lo, hi, n = parts[field]
            kw.update(partition_column=col, lower_bound=lo, upper_bound=hi, num_partitions=n)
        frames[field] = lambda kw=kw: read_jdbc(spark, **kw)
    return Tables(**frames)


__all__ = ["jdbc_options", "read_jdbc", "load_jdbc_tables", "TRADING_TABLES"]
