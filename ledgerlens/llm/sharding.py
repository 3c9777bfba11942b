"""Shards by minimax contiguous partition.

Groups of equal texts stay whole.  Ordered by the digest of their text, they are
cut into consecutive shards so that the largest shard is as small as it can be: the
smallest capacity is searched by bisection, and each candidate is checked
greedily (a shard takes groups up to the capacity, then the next one begins).

The greedy check only asks, for a limit ``t``, for the last group that ends at or
before ``t``.  The driver answers from a bounded table: group ends are put into
buckets of equal width, of which it holds the least and the greatest end.  If an
answer falls inside a bucket, the check is run twice, once with the last known end
and once with ``t`` itself; the two bracket the capacity.  Only the ranges in
question are then put into finer buckets, until every answer is exact.

One group may be larger than an even share, and then many cuts meet the least
capacity.  Among them, each shard ends as near as it can to an even share of what is
left, as long as the capacity still suffices for the rest.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import pairwise

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import narrow, shared_table

BUCKETS = 4096  # per range and round: bounds what the driver holds


class Ends:
    """What the driver knows of the groups' ends: some of them, sorted, and after
    which of these further ends may lie before the next known one."""

    def __init__(self, total: int) -> None:
        self.known, self.more = [0, total], {0}

    def learn(self, lo: int, hi: int, rows: list[tuple[int, int, int]]) -> None:
        """Buckets (least end, greatest end, number of ends) of all ends in (lo, hi]."""
        inside = sorted({e for a, z, _ in rows for e in (a, z)})
        self.known = [e for e in self.known if not lo < e <= hi]
        self.known = sorted({*self.known, *inside, lo})
        self.more = {e for e in self.more if not lo <= e <= hi} | {e for e in self.more if e == hi} | {a for a, z, n in rows if n > 2}

    def before(self, limit: int, high: bool) -> int:
        """Last end at or before ``limit``: the last known one, or with ``high``
        the most it can be."""
        last = self.known[bisect_right(self.known, limit) - 1]
        return limit if high and last < limit and last in self.more else last

    def greedy(self, capacity: int, shards: int, high: bool) -> list[int]:
        """Ends of the shards when each takes groups up to ``capacity``."""
        cuts, at, total = [], 0, self.known[-1]
        for _ in range(shards):
            at = max(at, self.before(min(at + capacity, total), high))
            cuts.append(at)
        return cuts

    def least_capacity(self, lo: int, hi: int, shards: int, high: bool) -> int:
        """Smallest feasible capacity in lo..hi by bisection; hi must be feasible."""
        while lo < hi:
            mid = (lo + hi) // 2
            lo, hi = (lo, mid) if self.greedy(mid, shards, high)[-1] >= self.known[-1] else (mid + 1, hi)
        return hi

    def unclear(self, low: int, high: int, shards: int) -> list[tuple[int, int]]:
        """Ranges with unknown ends that a check of a capacity in low..high may ask for."""
        below = [0, *self.greedy(low, shards, False)]
        above = [0, *self.greedy(high, shards, True)]
        ranges: list[tuple[int, int]] = []
        for a, b in zip(below[:-1], above[:-1]):
            i, j = bisect_right(self.known, a + low) - 1, bisect_left(self.known, b + high)
            gaps = [(lo, hi) for lo, hi in pairwise(self.known[i : j + 1]) if lo in self.more and a + low < hi and lo < b + high]
            if gaps:
                ranges.append((gaps[0][0], gaps[-1][1]))
        merged: list[tuple[int, int]] = []
        for lo, hi in sorted(ranges):
            if merged and lo < merged[-1][1]:
                merged[-1] = (merged[-1][0], max(hi, merged[-1][1]))
            else:
                merged.append((lo, hi))
        return merged

    def even(self, capacity: int, shards: int, grain: int = 1500) -> list[int]:
        """Cuts within the capacity whose shards are as even as can be (least sum
        of squares), out of some ``grain`` known ends and the greedy cuts."""
        thin = self.known[:: -(-len(self.known) // grain)]
        places = np.array(sorted({0, self.known[-1], *thin, *self.greedy(capacity, shards, False)}), np.float64)
        size = places[None, :] - places[:, None]
        cost = np.where((size >= 0) & (size <= capacity), (size / places[-1]) ** 2, np.inf)
        best, came = cost[0], []
        for _ in range(shards - 1):
            total = best[:, None] + cost
            came.append(total.argmin(axis=0))
            best = total.min(axis=0)
        at = len(places) - 1
        cuts = [at]
        for step in reversed(came):
            at = step[at]
            cuts.append(at)
        return [int(places[i]) for i in reversed(cuts)]


def cut_places(groups: DataFrame, total: int, largest: int, shards: int, buckets: int = BUCKETS) -> list[int]:
    """Ends (running sizes) of the shards.  ``groups`` has a column ``end``: the
    running size up to and with each group."""
    ends = Ends(total)
    low, high = max(-(-total // shards), largest), -(-total // shards) + largest
    ranges = [(0, total)]
    while ranges:
        place = F.lit(None).cast("long")
        for k, (lo, hi) in enumerate(ranges):
            width = -(-(hi - lo) // buckets)
            bucket = k * buckets + F.floor((F.col("end") - lo - 1) / width)
            place = F.when((F.col("end") > lo) & (F.col("end") <= hi), bucket).otherwise(place)
        found = groups.select("end", place.alias("b")).where("b is not null").groupBy("b")
        found = found.agg(F.min("end").alias("a"), F.max("end").alias("z"), F.count(F.lit(1)).alias("n")).collect()
        for k, (lo, hi) in enumerate(ranges):  # at most `buckets` rows for each
            ends.learn(lo, hi, [(r["a"], r["z"], r["n"]) for r in found if r["b"] // buckets == k])
        high = ends.least_capacity(low, high, shards, False)
        low = ends.least_capacity(low, high, shards, True)
        ranges = ends.unclear(low, high, shards)
    return ends.even(high, shards)


def shard(docs: DataFrame, id: str = "doc_id", text: str = "text", shards: int = 16, buckets: int = BUCKETS) -> DataFrame:
    """``(id, size, text_crc32, shard, slot)`` per row.

    ``size`` is the text's UTF-8 bytes plus 1; null texts count and group as empty
    ones.  ``slot`` numbers a shard's rows without gaps from 0.  Repeated rows stay
    separate rows of one group.  An empty table gives no rows; with few groups,
    the last shards stay empty.

    Rows get their shard from the digest ranges, without a join.  A group that holds a
    third of all rows is one row where groups are ordered, and its rows are numbered
    by partition of a written table, spread over the tasks.
    """
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = narrow(docs, id, text).select(
        id, (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"), F.sha2(raw, 256).alias("_digest")
    )
    rows = shared_table(rows.withColumn("_row", F.monotonically_increasing_id()), "sizes")
    # Running sizes: by the digests' first four digits, then within them.
    groups = rows.groupBy("_digest").agg(F.sum("size").alias("size")).withColumn("_head", F.substring("_digest", 1, 4))
    groups = shared_table(groups, "groups")
    heads = groups.groupBy("_head").agg(F.sum("size").alias("size"), F.max("size").alias("largest"))
    total, starts = 0, []
    largest = 0
    for r in sorted(heads.collect(), key=lambda r: r["_head"]):  # at most 65,536 rows
        starts.append((r["_head"], total))
        total += r["size"]
        largest = max(largest, r["largest"])
    if not total:
        return rows.select(id, "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    start = docs.sparkSession.createDataFrame(starts, "_head string, _before long")
    running = Window.partitionBy("_head").orderBy("_digest")
    groups = groups.join(F.broadcast(start), "_head").select("_digest", (F.col("_before") + F.sum("size").over(running)).alias("end"))
    groups = shared_table(groups, "ends")
    cuts = cut_places(groups, total, largest, shards, buckets)
    cuts = sorted({*cuts} - {0})  # without empty shards: those come last
    last = {r["end"]: r["_digest"] for r in groups.where(F.col("end").isin(cuts)).collect()}  # one row per shard
    # A row's shard: how many shards end before its digest.
    rows = rows.withColumn("shard", sum(((F.col("_digest") > last[c]).cast("int") for c in cuts[:-1]), F.lit(0)))
    rows = rows.withColumn("_part", F.shiftright("_row", 33).cast("int"))
    counts = rows.groupBy("shard", "_part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = shared_table(counts.select("shard", "_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before")), "offsets")
    within = Window.partitionBy("shard", "_part").orderBy("_row")
    rows = rows.withColumn("_n", F.row_number().over(within) - 1).join(offsets, ["shard", "_part"])
    return rows.select(id, "size", "text_crc32", "shard", (F.col("_n") + F.col("_before")).cast("long").alias("slot"))
