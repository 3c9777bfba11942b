"""Bucketed physical layout of the brokerage tables.

The largest joins pair tables on the same key: activities with their legs on
the activity id, orders with their legs on the order id.  Written as bucketed
tables with the same bucket count on those keys, each pair is read
co-partitioned and Spark joins them without shuffling either side.  Written
once (for example nightly, into the shared warehouse), the layout serves
every later query; the operators need no change.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ledgerlens.sources.fixtures import TABLE_NAMES, Tables

# Bucketing (and in-bucket sort) key per table; tables not listed are small
# dimensions or are joined on varying keys, and are written plainly.
BUCKET_KEYS = {
    "activities": "id",
    "activity_legs": "activity_id",
    "orders": "id",
    "order_legs": "order_id",
}


def write_bucketed_tables(tables: Tables, database: str, buckets: int, mode: str = "errorifexists") -> None:
    """Save every table into ``database``, bucketing the joined pairs.

    ``buckets`` should give buckets of a few hundred MB for the largest table
    (input size / 256 MB); both tables of a pair use the same count so their
    buckets line up.
    """
    spark = tables.activities.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in TABLE_NAMES:
        df = getattr(tables, name)
        writer = df.write.mode(mode).format("parquet")
        key = BUCKET_KEYS.get(name)
        if key:
            writer = writer.bucketBy(buckets, key).sortBy(key)
        writer.saveAsTable(f"{database}.{name}")


def load_catalog_tables(spark: SparkSession, database: str) -> Tables:
    """The brokerage tables as saved by ``write_bucketed_tables``."""
    return Tables(**{n: (lambda n=n: spark.table(f"{database}.{n}")) for n in TABLE_NAMES})
