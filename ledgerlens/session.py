"""Spark session defaults used by tests, the bench and the entry point."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def get_session(
    app: str = "ledgerlens",
    master: str | None = None,
    shuffle_partitions: int | None = None,
) -> SparkSession:
    """Return (or create) a *local* session with the settings the operators
    assume (tests, the bench, notebooks).  On a cluster, build the session
    with cluster-sized settings and call ``configure_session`` on it instead.

    * UTC session zone: the fixtures hold wall-clock timestamps
      (``timestamp_ntz``), and date truncation must not shift them.
    * AQE on, with partition coalescing and skew-join splitting (forced even
      where a split needs an extra shuffle), so one hot account, order or
      currency does not pin a whole join to one task.
    * No web UI.
    """
    master = master or os.environ.get("LEDGERLENS_MASTER", "local[*]")
    parts = shuffle_partitions or int(os.environ.get("LEDGERLENS_SHUFFLE_PARTITIONS", "8"))
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        # Shuffle partition size after AQE coalescing: cluster values.  On a
        # laptop-sized input every stage would become one task, so the bench
        # sets its own.
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes",
                os.environ.get("LEDGERLENS_ADVISORY_PARTITION", "128m"))
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize",
                os.environ.get("LEDGERLENS_MIN_PARTITION", "16m"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("LEDGERLENS_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def configure_session(spark: SparkSession) -> None:
    """Apply the settings operators rely on to a session made elsewhere."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # Several plans aggregate right after a join on the same key (the trade
    # blotter's distinct reuses the order-id partitioning).  Without this,
    # AQE declines to split a hot join key there, because the split needs one
    # more shuffle for the aggregate; with it, that shuffle is added only
    # when a skewed partition is actually found.
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    # A JSON object may name a field twice; the last value counts, as in PostgreSQL.
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
