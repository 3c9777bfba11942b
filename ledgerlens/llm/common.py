"""Helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space that separates words: space and the controls tab to carriage
# return.  Java and DuckDB (RE2) read both classes alike.
SPACES = r"[\x20\x09-\x0D]+"
WORD_CHAR = r"[^\x20\x09-\x0D]"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` as
    the cluster names it, else the context's checkpoint folder, else (one
    machine, as in tests) a temporary one that is then set."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerlens-"))
        named = sc.getCheckpointDir()
    return named.rstrip("/")


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again.  Cuts the
    lineage: a lost executor costs no recomputation of what lies before."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Arrow batches that stay small when texts are long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def narrow(df: DataFrame, *columns: str) -> DataFrame:
    """Only ``columns``, by their exact names.  Other columns may have the
    same names in another case, or names that an operator adds: they are
    renamed by position first, so no reference to them is ambiguous."""
    seen: set[str] = set()
    names = []
    for i, c in enumerate(df.columns):
        fresh = c in columns and c not in seen
        names.append(c if fresh else f"_other_{i}")
        seen.add(c)
    missing = [c for c in columns if c not in seen]
    if missing:
        raise ValueError(f"no column {missing} in {df.columns}")
    return df.toDF(*names).select(*columns)


def row_key(*columns: Column) -> list[Column]:
    """Two 64-bit hashes, ``k1`` and ``k2``, that identify a row by the given
    columns.  Rows equal in all of them are one document to an operator; their
    copies get equal results.  Never null."""
    flags = [c.isNull() for c in columns]
    return [F.xxhash64(F.lit(1), *columns, *flags).alias("k1"), F.xxhash64(*reversed(columns), F.lit(2), *flags).alias("k2")]


FILTER_BITS = 27  # 16 MB, whatever the number of keys


def key_filter(keys: DataFrame) -> DataFrame:
    """``(bucket, bits)``: a bitmap of ``2 ** FILTER_BITS`` bits with the bit of each ``k1``
    set, cut into rows of 4 KB, written to the shared folder.  Its size has a fixed bound,
    so it may be broadcast."""
    at = F.pmod(F.col("k1"), F.lit(1 << FILTER_BITS)) + 1
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")
    return shared_table(keys.groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(bits), "filter")


def split_by_keys(df: DataFrame, k1: Column, bitmap: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``df`` whose ``k1`` may be a key of the filter, and those whose certainly
    is none.  The second need not meet the keys in a join, so they are not shuffled.
    ``df`` has no columns named ``_bucket``, ``_bits`` or ``_place``."""
    at = F.pmod(k1, F.lit(1 << FILTER_BITS)) + 1
    parts = F.broadcast(bitmap.select(F.col("bucket").alias("_bucket"), F.col("bits").alias("_bits")))
    rows = df.withColumn("_place", at).join(parts, F.bitmap_bucket_number("_place") == F.col("_bucket"), "left")
    position = F.bitmap_bit_position("_place")
    byte = F.conv(F.hex(F.substring("_bits", (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    found = F.coalesce(byte.bitwiseAND(F.pow(F.lit(2), position % 8).cast("int")) != 0, F.lit(False))
    return rows.where(found).select(*df.columns), rows.where(~found).select(*df.columns)
