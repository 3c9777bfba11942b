"""File sources: brokerage tables as parquet, payloads as JSON documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.sources.fixtures import TABLE_NAMES, Tables


def load_parquet_tables(spark: SparkSession, root: str) -> Tables:
    """Brokerage tables stored as ``{root}/<table>`` parquet datasets (for
    example exported from the trading database, partitioned by day)."""
    return Tables(**{n: (lambda n=n: spark.read.parquet(f"{root}/{n}")) for n in TABLE_NAMES})


def read_payload_files(spark: SparkSession, path: str, key_col: str = "key") -> DataFrame:
    """Payload documents stored one JSON document per file (as fetched from
    an API).  Returns ``key`` (the file path) and ``body`` (the raw text),
    the shape the payload operators take; parsing happens there, with an
    explicit schema, so malformed documents become nulls instead of failing
    the job.  A file is read whole into one row: for documents of up to some tens of
    megabytes; larger exports belong in JSON lines."""
    df = spark.read.text(path, wholetext=True)
    return df.select(F.input_file_name().alias(key_col), F.col("value").alias("body"))


def read_payload_lines(spark: SparkSession, path: str, key_col: str = "key") -> DataFrame:
    """Payload documents stored as JSON lines: one document per line."""
    df = spark.read.text(path)
    return df.select(F.input_file_name().alias(key_col), F.col("value").alias("body"))
