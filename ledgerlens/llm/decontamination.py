"""Benchmark decontamination by spaced-seed hashing, in DataFrame functions only.

A seed mask covers ``SPAN`` consecutive words and ignores some of them, so a
substituted word does not hide a match.  Every place of every text and of every
benchmark item is hashed under each mask; equal hashes are hits.  Around each hit, a
frame of up to ``FRAME`` words of the item is compared with the aligned words of
the text, and an overlap counts if at least ``SHARE`` percent of the frame's words are
equal in place, or ``RUN`` of them in a row.  An item too short for a mask, of ``SHORTEST``
words at least, is hashed whole and must stand in the text word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import key_filter, narrow, row_key, shared_table, split_by_keys

MASKS = ("1101011011", "1110010111")
SPAN = len(MASKS[0])
FRAME, SHARE, RUN = 20, 80, 10
# Items of fewer words are ordinary language and match nothing.
SHORTEST = 4
# Seeds are broadcast up to so many rows and bytes of words; more are joined by a shuffle
# of the texts' hashes.
BROADCAST_SEEDS, BROADCAST_BYTES = 100_000, 32 << 20


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits; none for a null text."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _hashes(of: str, at: Column) -> Column:
    """The hash under each mask of the words from place ``at`` (0-based)."""
    places = [[k for k, c in enumerate(m) if c == "1"] for m in MASKS]
    return F.array(*(F.xxhash64(F.lit(n), *(F.get(F.col(of), at + k) for k in p)) for n, p in enumerate(places)))


def _whole(of: str, at: Column, n: int) -> Column:
    """The hash of the ``n`` words from place ``at``."""
    return F.xxhash64(F.lit(100 + n), *(F.get(F.col(of), at + k) for k in range(n)))


def seeds(items: DataFrame, id: str = "item_id", text: str = "text") -> DataFrame:
    """``(h, item, at, frame)``: per mask and place of an item, its hash, the place
    in the item where the frame around it begins, relative to the seed, and the
    frame's words.  An item of fewer than ``SPAN`` words, and of ``SHORTEST`` at least, is
    one seed and its own frame."""
    rows = narrow(items, id, text).select(F.col(id).alias("item"), words(F.col(text)).alias("_w"))
    short = rows.where(F.size("_w").between(SHORTEST, SPAN - 1))
    by_size = F.coalesce(*(F.when(F.size("_w") == n, _whole("_w", F.lit(0), n)) for n in range(SHORTEST, SPAN)))
    short = short.select(by_size.alias("h"), "item", F.lit(0).alias("at"), F.col("_w").alias("frame"))
    rows = rows.where(F.size("_w") >= SPAN).select("item", "_w", F.explode(F.sequence(F.lit(0), F.size("_w") - SPAN)).alias("_at"))
    n = F.least(F.size("_w"), F.lit(FRAME))
    begin = F.greatest(F.lit(0), F.least(F.col("_at") - (FRAME - SPAN) // 2, F.size("_w") - n))
    rows = rows.select("item", (begin - F.col("_at")).alias("at"), F.slice("_w", begin + 1, n).alias("frame"), _hashes("_w", F.col("_at")).alias("_h"))
    return rows.select(F.explode("_h").alias("h"), "item", "at", "frame").unionByName(short).distinct()


def _compared(hits: DataFrame) -> DataFrame:
    """Of hits with the text's words ``_w``, those that count, with their equal words ``n``."""
    same = F.transform("frame", lambda w, k: F.when(F.get(F.col("_w"), F.col("_start") + k) == w, "1").otherwise("0"))
    hits = hits.withColumn("_same", F.array_join(same, ""))
    equal = F.length(F.regexp_replace("_same", "0", ""))
    enough = (100 * equal >= SHARE * F.size("frame")) | F.col("_same").contains("1" * RUN)
    return hits.withColumn("n", equal).where(enough).drop("_w", "_same")


def overlaps(
    docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """``(id, k1, k2, item, n_frames, best)`` per text and benchmark item with a
    verified overlap: number of different frames that match, and the most equal
    words in one.  Null, empty and short texts overlap nothing, nor do items of fewer than
    ``SHORTEST`` words; equal rows count as one text; an empty table on either side gives
    no rows.

    The texts' hashes are made and probed in one pass, without a shuffle, as long as the
    seeds fit the checked bounds.  Only texts whose key is in a filter of the hits' keys, a
    bitmap of fixed size, go on to be compared; no other text is shuffled.  Hits are rows,
    so a passage in a third of all texts, or many items in one text, fill no single row.
    """
    found = shared_table(seeds(items, item_id, item_text), "seeds")
    size = found.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.array_join("frame", " "))).alias("bytes")).first()
    lengths = found.where(F.size("frame") < SPAN).select(F.size("frame").alias("n")).distinct().collect()  # SPAN values at most
    rows = narrow(docs, id, text)
    keyed = rows.select(id, F.col(text).alias("_text"), *row_key(F.col(id), F.col(text)))
    shortest = min([SPAN, *(r["n"] for r in lengths)])
    places = keyed.select("k1", "k2", words(F.col("_text")).alias("_w")).where(F.size("_w") >= shortest)
    places = places.select("k1", "k2", "_w", F.explode(F.sequence(F.lit(0), F.size("_w") - shortest)).alias("_place"))
    left, hashes = F.size("_w") - F.col("_place"), _hashes("_w", F.col("_place"))
    if lengths:
        none = F.array().cast("array<bigint>")
        own = [F.when(left >= r["n"], F.array(_whole("_w", F.col("_place"), r["n"]))).otherwise(none) for r in lengths]
        hashes = F.concat(F.when(left >= SPAN, hashes).otherwise(none), *own)
    hashed = places.select("k1", "k2", "_place", F.explode(hashes).alias("h"))
    small = size["n"] <= BROADCAST_SEEDS and (size["bytes"] or 0) <= BROADCAST_BYTES
    hits = hashed.join(F.broadcast(found) if small else found, "h")
    hits = shared_table(hits.select("k1", "k2", "item", (F.col("_place") + F.col("at")).alias("_start"), "frame"), "hits")
    texts, _ = split_by_keys(keyed, F.col("k1"), key_filter(hits))
    texts = texts.select(id, "k1", "k2", words(F.col("_text")).alias("_w"))
    hits = _compared(texts.join(hits, ["k1", "k2"]))
    each = hits.groupBy(id, "k1", "k2", "item", "_start", "frame").agg(F.max("n").alias("n"))
    return each.groupBy(id, "k1", "k2", "item").agg(F.count(F.lit(1)).alias("n_frames"), F.max("n").alias("best"))


def drop_contaminated(
    docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """The rows of ``docs``, all columns, without a verified overlap.  Rows whose key is
    in no filter pass without a shuffle."""
    names = docs.columns
    inner = [f"_c{i}" for i in range(len(names))]
    k1, k2 = row_key(F.col(inner[names.index(id)]), F.col(inner[names.index(text)]))
    dirty = overlaps(docs, items, id, text, item_id, item_text).select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2")).distinct()
    rows = docs.toDF(*inner).withColumns({"_k1": k1, "_k2": k2})
    dirty = shared_table(dirty, "dirty")
    maybe, clean = split_by_keys(rows, F.col("_k1"), key_filter(dirty.withColumnRenamed("_k1", "k1")))
    kept = clean.unionByName(maybe.join(dirty, ["_k1", "_k2"], "left_anti"))
    return kept.select(*inner).toDF(*names)
