"""SimHash near-duplicates through covering locality-sensitive hashing.

Fingerprints of 64 bits link when they differ in at most ``radius`` bits.  The
tables' masks are structured so that no such pair is missed: every bit ``i``
gets a non-zero vector ``m(i)`` of ``radius + 1`` bits, and the mask of table
``v`` (all non-zero vectors) holds the bits whose ``m(i) . v`` is odd.  The
vectors of ``radius`` differing bits can't span the whole space, so some ``v``
is orthogonal to all of them; that table's mask holds none of the differing
bits, and the pair falls into one bucket there.  For radius 3 that makes 15
tables of about 34 bits each.

Buckets are compared block by block when they hold at most ``bucket_rows``
fingerprints.  A larger one is split by a further family of masks, whose guarantee
is the same, as often as needed; each level leaves about half of the free bits,
so the loop ends: a bucket with ``b`` free bits holds at most ``2 ** b`` different
fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from ledgerlens.llm.common import narrow, row_key, shared_table, small_batches
from ledgerlens.llm.components import connected_components

BITS = 64


def masks(radius: int, level: int = 0) -> list[int]:
    """Masks of the ``2 ** (radius + 1) - 1`` tables; ``level`` names an
    independent family (the bits are dealt to the vectors in another order)."""
    n = (1 << (radius + 1)) - 1
    order = np.random.default_rng(level).permutation(BITS) if level else np.arange(BITS)
    vector = [int(order[i]) % n + 1 for i in range(BITS)]
    return [sum(1 << i for i in range(BITS) if (vector[i] & v).bit_count() % 2) for v in range(1, n + 1)]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >= 1 << (BITS - 1) else x


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """Unsigned fingerprint of one text (UTF-8)."""
    words = (text or b"").lower().split()  # ASCII letters and ASCII white space only
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    hashes = np.fromiter(map(partial(xxh64_intdigest, seed=42), grams), np.uint64)
    n = len(hashes)
    ones = np.zeros(BITS, np.int64)
    # Eight bits to a 64-bit lane, one byte each: sums of 255 rows fit a byte.
    for at in range(0, n, 255 * 256):
        bits = np.unpackbits(hashes[at : at + 255 * 256].astype(">u8").view(np.uint8)).view(np.uint64).reshape(-1, 8)
        for part in range(0, len(bits), 255):
            ones += bits[part : part + 255].sum(axis=0, dtype=np.uint64).view(np.uint8)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """``(id, k1, k2, fp)`` per row: fingerprint as a signed long.  Words are
    split at ASCII white space after lower-casing A-Z; shingles count as often
    as they occur; fewer words than a shingle make one shingle; no words or a null
    text make fingerprint 0."""
    small_batches(docs.sparkSession)
    rows = narrow(docs, id, text)
    rows = rows.select(F.col(id), *row_key(F.col(id), F.col(text)), F.col(text).cast("binary").alias("_text"))
    schema = rows.drop("_text").schema.add("fp", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [_signed(fingerprint(t, shingle)) for t in b.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(fps, pa.int64())], names=[*b.schema.names[:-1], "fp"])

    return rows.mapInArrow(run, schema)


def stars(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links within one bucket (fingerprints as unsigned 64-bit), as one star per
    linked group: the smallest (as signed) with each of the others.  Every
    fingerprint is compared with all that no group has taken yet."""
    left = np.sort(fps.astype(np.int64)).view(np.uint64)
    out = []
    while len(left) > 1:
        root, group, left = left[0], [left[:1]], left[1:]
        while group and len(left):
            for x in group.pop():
                near = np.bitwise_count(left ^ x) <= radius
                if near.any():
                    found, left = left[near], left[~near]
                    group.append(found)
                    out.extend((int(root.view(np.int64)), y) for y in found.view(np.int64).tolist())
    return out


def links(distinct: DataFrame, radius: int = 3, bucket_rows: int = 4096) -> DataFrame:
    """``distinct(fp)`` to links ``(a, b)`` that join exactly the fingerprints
    that chains of pairs within ``radius`` join."""
    spark = distinct.sparkSession
    found = None
    rows = distinct.select(F.lit(0).cast("long").alias("b"), "fp")
    level = 0
    while True:
        keys = [
            F.xxhash64(F.col("b"), F.lit(t), F.col("fp").bitwiseAND(F.lit(_signed(m))))
            for t, m in enumerate(masks(radius, level))
        ]
        keyed = rows.select(F.explode(F.array(*keys)).alias("b"), "fp")
        sizes = shared_table(keyed.groupBy("b").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets")
        held = keyed.join(sizes, "b")
        light = held.where(F.col("n") <= bucket_rows).groupBy("b").agg(F.collect_list("fp").alias("fps"))
        pairs = light.select("fps").mapInArrow(partial(_compare, radius=radius), "a long, b long").distinct()
        pairs = shared_table(pairs, "pairs")
        found = pairs if found is None else found.unionByName(pairs)
        if sizes.where(F.col("n") > bucket_rows).isEmpty():
            return found
        rows = shared_table(held.where(F.col("n") > bucket_rows).select("b", "fp"), "heavy")
        level += 1


def _compare(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        lists = b.column("fps")
        ends, values = lists.offsets.to_numpy(), lists.values.to_numpy()
        a, c = [], []
        for lo, hi in zip(ends[:-1].tolist(), ends[1:].tolist()):
            if hi - lo == 2:
                x, y = int(values[lo]), int(values[lo + 1])
                pairs = [(min(x, y), max(x, y))] if np.bitwise_count(np.uint64((x ^ y) & (1 << BITS) - 1)) <= radius else []
            else:
                pairs = stars(values[lo:hi].view(np.uint64), radius)
            for x, y in pairs:
                a.append(x)
                c.append(y)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(c, pa.int64())], names=["a", "b"])


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 3, bucket_rows: int = 4096
) -> DataFrame:
    """Class of every row: ``(id, k1, k2, fp, component_id, first)``.

    ``component_id`` is the smallest id among the rows reachable over links of at
    most ``radius`` differing bits, itself included (null only where all of
    them have a null id); ``first`` is a struct ``(id, k1, k2)`` that names one row
    of the class, equal rows counting as one.  Nulls, empty and repeated texts:
    see ``fingerprints``.  An empty table gives no rows.

    Copies are one fingerprint before any candidate search; links of different
    fingerprints are kept as stars per bucket, never as all pairs.
    """
    rows = shared_table(fingerprints(docs, id, text, shingle), "fingerprints")
    # The least id goes with nulls last; `first` orders them the same way.
    named = F.struct(F.col(id).isNull().alias("none"), F.col(id).alias("id"), "k1", "k2")
    base = shared_table(rows.groupBy("fp").agg(F.min(named).alias("first")), "distinct")
    member = connected_components(links(base.select("fp"), radius, bucket_rows)).withColumnRenamed("node", "fp")
    member = shared_table(member.join(base, "fp"), "members")
    least = member.groupBy("root").agg(F.min("first").alias("least"))
    linked = member.select("fp", "root").join(least, "root").select("fp", "least")
    classes = base.join(linked, "fp", "left").select("fp", F.coalesce("least", "first").alias("first"))
    classes = shared_table(classes, "classes")
    return rows.join(classes, "fp").select(
        id, "k1", "k2", "fp", F.col("first.id").alias("component_id"), F.struct("first.id", "first.k1", "first.k2").alias("first")
    )


def fingerprint_hex(fp: str = "fp"):
    """16 lower-case hex digits of a fingerprint column."""
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 3) -> DataFrame:
    """The rows of ``docs``, all columns, without near-duplicates: of each class
    the row with the smallest id stays (nulls last; ties by the rows' hashes), once."""
    names = docs.columns
    firsts = near_duplicates(docs, id, text, shingle, radius).select(F.col("first.k1").alias("_k1"), F.col("first.k2").alias("_k2"))
    firsts = shared_table(firsts.distinct(), "kept")
    inner = [f"_c{i}" for i in range(len(names))]
    k1, k2 = row_key(F.col(inner[names.index(id)]), F.col(inner[names.index(text)]))
    rows = docs.toDF(*inner).withColumns({"_k1": k1, "_k2": k2})
    return rows.join(firsts, ["_k1", "_k2"], "left_semi").dropDuplicates(["_k1", "_k2"]).select(*inner).toDF(*names)
