"""Date helpers."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def day_start(day: _dt.date) -> Column:
    """Midnight of ``day`` as a ``timestamp_ntz`` literal.

    Built from text, so neither the Python process's zone nor the session
    zone shifts it; against a ``timestamp`` (with zone) column Spark reads it
    as midnight in the session zone."""
    return F.lit(f"{day.isoformat()} 00:00:00").cast("timestamp_ntz")


def on_days(ts: Column, first: _dt.date, last: _dt.date) -> Column:
    """``cast(ts AS date) BETWEEN first AND last`` written as a half-open
    timestamp range, which parquet can push down as min/max row-group
    filters without evaluating the cast."""
    return (ts >= day_start(first)) & (ts < day_start(last + _dt.timedelta(days=1)))


def day_series(spark: SparkSession, first: _dt.date, last: _dt.date) -> DataFrame:
    """One row per calendar day, ``day`` as ``yyyy-MM-dd`` text.

    The operators never need this list: a day range is a single range
    predicate.  It exists for callers that want the calendar itself.
    """
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(first), F.lit(last), F.expr("INTERVAL 1 DAY"))).alias("d")
    ).select(F.date_format("d", "yyyy-MM-dd").alias("day"))
