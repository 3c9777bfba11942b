"""Line deduplication over overlapping windows of consecutive lines.

The lines of a text that hold a word, in order, form overlapping windows of
``width`` lines (three by default), compared by their lines without outer
spaces.  A window that occurs before, in the whole table, is a repeat; order is by
id (null ids first), then by the row's hashes, then by position.  The lines that a
text's repeats cover, merged, are removed; the first occurrence stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import WORD_CHAR, key_filter, row_key, shared_table, split_by_keys


def _worded(text: Column) -> Column:
    """``array<struct<i, l>>``: place (from 0) and trimmed text of each line with a word."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    return F.filter(F.transform(lines, lambda l, i: F.struct(i.alias("i"), F.trim(l).alias("l"))), lambda s: s["l"].rlike(WORD_CHAR))


def windows(docs: DataFrame, id: str, text: str, width: int = 3) -> DataFrame:
    """``(id, k1, k2, at, h1, h2)``: one row per window; ``at`` counts the lines
    with a word before it.  A text with fewer such lines has no window."""
    rows = docs.select(F.col(id), *row_key(F.col(id), F.col(text)), _worded(F.col(text)).alias("_lines"))
    rows = rows.where(F.size("_lines") >= width)

    def window(at: Column) -> Column:
        parts = [F.get(F.col("_lines"), at + k)["l"] for k in range(width)]
        return F.struct(at.alias("at"), F.xxhash64(*parts).alias("h1"), F.xxhash64(F.lit(width), *reversed(parts)).alias("h2"))

    return rows.select(
        id, "k1", "k2", F.inline(F.transform(F.sequence(F.lit(0), F.size("_lines") - width), window))
    )


def line_dedup(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """All rows and columns of ``docs`` with the cleaned ``text``, and
    ``_lines`` (lines with a word before), ``_removed`` (places, from 0, of the
    removed lines in the text as split at ``\\n``).

    Null and empty texts, and texts without a repeat, stay as they are.  A text
    that consists of repeats becomes empty; its row stays.  Rows equal in id and
    text are one document: copies get the same result.  An empty table gives no
    rows.  Columns of any other name pass through (names starting with ``_lines``
    or ``_removed`` are the operator's own).

    Windows are aggregated to their first place per hash, partially before the
    shuffle.  Only hashes that repeat are joined back, from a written table, so
    that a window that a third of all texts hold is split over tasks.  Texts meet their
    cuts by key; those whose key is not in a filter of fixed size have none and are not
    shuffled.
    """
    names = docs.columns
    inner = [f"_c{i}" for i in range(len(names))]
    rows = docs.toDF(*inner)
    key, body = inner[names.index(id)], inner[names.index(text)]
    found = windows(rows.select(key, body), key, body, width)
    place = F.struct(F.col(key).alias("id"), "k1", "k2", "at")
    first = found.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    first = shared_table(first, "first-windows")
    repeats = found.join(first, ["h1", "h2"]).where(place > F.col("first"))
    cuts = shared_table(repeats.groupBy("k1", "k2").agg(F.collect_set("at").alias("_cuts")), "cuts")
    k1, k2 = row_key(F.col(key), F.col(body))
    rows = rows.withColumns({"k1": k1, "k2": k2})
    maybe, whole = split_by_keys(rows, F.col("k1"), key_filter(cuts))
    joined = maybe.join(cuts, ["k1", "k2"], "left").select(*inner, "_cuts")
    joined = joined.unionByName(whole.select(*inner, F.lit(None).cast("array<int>").alias("_cuts")))
    # Fresh select so that the lines are computed once, not per element below.
    joined = joined.select(
        *inner, "_cuts", F.split(F.coalesce(F.col(body), F.lit("")), "\n", -1).alias("_all"), _worded(F.col(body))["i"].alias("_i")
    )
    covered = F.array_distinct(F.flatten(F.transform("_cuts", lambda at: F.array(*(at + k for k in range(width))))))
    gone = F.array_sort(F.transform(covered, lambda at: F.get(F.col("_i"), at)))
    joined = joined.select(*inner, "_all", F.size("_i").alias("_lines"), F.coalesce(gone, F.array().cast("array<int>")).alias("_removed"))
    left = F.array_except(F.sequence(F.lit(0), F.size("_all") - 1), F.col("_removed"))
    clean = F.when(F.size("_removed") == 0, F.col(body)).otherwise(
        F.array_join(F.transform(left, lambda at: F.get(F.col("_all"), at)), "\n")
    )
    out = joined.select(*(clean.alias(c) if c == body else F.col(c) for c in inner), "_lines", "_removed")
    return out.toDF(*names, "_lines", "_removed")
