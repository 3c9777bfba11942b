"""Global order that a table itself proves: range-partitioned writes, row numbers.

A window without partitions numbers rows in one task.  Here the rows are written in
ranges of the order, each sorted, and a row's number is its place in its file plus the rows
of the files before: the count per file is all that meets in one place.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share: ``spark.checkpoint.dir`` as
    the cluster names it, else the context's checkpoint folder, else (one machine, as in
    tests) a temporary one that is then set."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if root is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerlens-"))
        root = sc.getCheckpointDir()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_ordered(df: DataFrame, path: str, by: Sequence[Column], partitions: int | None = None) -> None:
    """Write ``df`` to ``path`` as Parquet files whose rows, file after file by name, are in
    the order ``by``.

    Ranges are cut at sampled keys of ``by``; rows equal in all of it share a file, so give
    an order that ends in columns that tell rows apart.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.repartitionByRange(n, *by).sortWithinPartitions(*by).write.parquet(path)


def read_numbered(spark: SparkSession, path: str, name: str = "row_no") -> DataFrame:
    """What ``write_ordered`` wrote, with each row's number in the order, from 1 and
    without gaps."""
    rows = spark.read.parquet(path)
    placed = rows.select(*rows.columns, F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_place"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    files = placed.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))  # a row per file
    starts = files.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    out = placed.join(F.broadcast(starts), "_file")  # as many rows as the write had partitions
    return out.select(*rows.columns, (F.col("_start") + F.col("_place") + 1).alias(name))


def numbered(df: DataFrame, by: Sequence[Column], name: str = "row_no") -> DataFrame:
    """``df`` with ``name``, its rows' numbers in the order ``by``, through a table in the
    shared folder.  Runs at once."""
    path = scratch_path(df.sparkSession, "ordered")
    write_ordered(df, path, by)
    return read_numbered(df.sparkSession, path, name)
