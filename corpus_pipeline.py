"""Training-data pipeline: documents in, packed sequences out.

Each stage takes the Parquet that its predecessor wrote and works on all of it.  All
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import shared_table
from ledgerlens.llm.decontamination import drop_contaminated
from ledgerlens.llm.line_dedup import line_dedup
from ledgerlens.llm.packing import pack_documents
from ledgerlens.llm.queries import read, tokenizer_path
from ledgerlens.llm.simhash import keep_one
from ledgerlens.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; the model learns from ``labels``."""
    return drop_toxic(docs, read(spark, sf_dir, "labels"))


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line passages go from the texts; every document
    stays, one that was nothing else with an empty text.  ``n_chars`` follows.  Columns
    are taken by position: others may have any names."""
    names = docs.columns
    inner = [f"c{i}" for i in range(len(names))]
    text = inner[names.index("text")]
    clean = line_dedup(docs.toDF(*inner), inner[names.index("doc_id")], text)
    if "n_chars" in names:
        at = names.index("n_chars")
        follows = F.when(F.size("_removed") > 0, F.length(text)).otherwise(F.col(inner[at]))
        clean = clean.withColumn(inner[at], follows.cast(docs.schema[at].dataType))
    return clean.select(*inner).toDF(*names)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return keep_one(docs, shingle=3, radius=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of ``benchmark`` go."""
    return drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of at most 1024 tokens."""
    return pack_documents(docs, tokenizer_path(), capacity=1024, end_id=2)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", repeated_lines),
    ("simhash_near_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

# The stages learn, hash and tokenize: SQL can't express them.  Tested against
# brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = shared_table(stage(spark, docs, sf_dir), name)
    return docs
