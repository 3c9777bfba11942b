"""Hard negatives by inner product, searched in an STR-packed R-tree.

The vectors are range-partitioned by label and first components into parts of bounded
size; each part is packed by sort-tile-recursive into leaves of one label, written as rows
with their minimum bounding boxes.  A box gives, per coordinate, the interval of the
product with an anchor's coordinate, and so an interval of the inner product with any
vector inside.  The search takes boxes best first from a queue ordered by the upper end:
a box goes if its interval misses every score window that is asked for, or if its upper end
is strictly below the k-th best score so far.

Anchors are a stated query set.  They meet the parts in blocks of bounded size: a task
holds one part and one block, and hands on at most k rows per anchor and window.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import narrow, shared_table

PART, LEAF, FANOUT, BLOCK = 1 << 16, 64, 16, 1 << 16
# Components that are this large after scaling give scores that float64 sums and 64-bit
# comparisons no longer hold exactly.
LIMIT = 1 << 20


def integer_rows(rows: DataFrame, scale: float, id: str = "vec_id", label: str = "label", vector: str = "embedding") -> DataFrame:
    """``(id, label, q)`` of the rows with an id, a label and a vector whose components
    are all finite: ``q`` is ``floor(scale * x)`` of each.  A component of 2^20 or more in
    size after scaling is too large for exact scores and counts as infinite."""
    v = narrow(rows, id, label, vector).select(
        F.col(id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("v")
    )
    fits = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x * F.lit(float(scale))) < LIMIT), F.lit(False)))
    v = v.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(fits, F.lit(False)))
    return v.select("id", "label", F.transform("v", lambda x: F.floor(x * F.lit(float(scale))).cast("int")).alias("q"))


def tiles(q: np.ndarray, leaf: int = LEAF) -> list[np.ndarray]:
    """Row numbers of each leaf: sort-tile-recursive over the (up to) three coordinates
    that vary most, slabs of equal size along one, then along the next."""
    if not len(q):
        return []
    axes = np.argsort(-q.var(axis=0), kind="stable")[:3] if q.shape[1] else []

    def cut(at: np.ndarray, left: list[int]) -> list[np.ndarray]:
        leaves = -(-len(at) // leaf)
        if not left or leaves <= 1:
            return [at[i : i + leaf] for i in range(0, len(at), leaf)]
        at = at[np.argsort(q[at, left[0]], kind="stable")]
        slab = leaf * math.ceil(leaves / math.ceil(leaves ** (1 / len(left))))
        return [t for i in range(0, len(at), slab) for t in cut(at[i : i + slab], left[1:])]

    return cut(np.arange(len(q)), list(axes))


def packed(rows: DataFrame, dims: int, parts: int) -> DataFrame:
    """The R-tree's leaves, written to the shared folder: ``(part, label, ids, q, low,
    high)``, ``q`` the vectors one after the other, padded with zeros to ``dims``.

    Rows that agree in id, label and vector are one.  A label with a third of all rows is
    cut by the first components and the id into as many ranges as its share needs.
    """
    first = [F.coalesce(F.get("q", F.lit(d)), F.lit(0)) for d in range(min(dims, 2))]
    ranged = rows.repartitionByRange(parts, "label", *first, "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen: dict[tuple[int, int, bytes], None] = {}
        for b in batches:
            flat, sizes = b.column("q").flatten().to_numpy(), b.column("q").value_lengths().to_numpy()
            for id, label, end, n in zip(b.column("id").to_pylist(), b.column("label").to_pylist(), np.cumsum(sizes), sizes):
                seen[label, id, flat[end - n : end].tobytes()] = None
        order = sorted(seen)
        q = np.zeros((len(order), dims), np.int32)
        for i, (_, _, v) in enumerate(order):
            own = np.frombuffer(v, np.int32)
            q[i, : len(own)] = own
        labels, ids = np.array([o[0] for o in order], np.int64), np.array([o[1] for o in order], np.int64)
        for label in np.unique(labels):
            own = np.flatnonzero(labels == label)
            for tile in tiles(q[own]):
                at = own[tile]
                yield pa.RecordBatch.from_pydict(
                    {"part": pa.array([part], pa.int32()), "label": pa.array([label], pa.int64()), "ids": [ids[at]], "q": [q[at].ravel()],
                     "low": [q[at].min(axis=0)], "high": [q[at].max(axis=0)]}
                )

    schema = "part int, label long, ids array<bigint>, q array<int>, low array<int>, high array<int>"
    return shared_table(ranged.mapInArrow(run, schema), "leaves")


class Tree:
    """A part's leaves under boxes of ``FANOUT`` neighbours, level by level up to one
    root per label."""

    def __init__(self, leaves: pa.Table, dims: int) -> None:
        def matrix(name: str) -> np.ndarray:
            return leaves.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)

        self.vectors = matrix("q").astype(np.float64)
        self.ids = leaves.column("ids").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        ends = np.cumsum(leaves.column("ids").combine_chunks().value_lengths().to_numpy())
        self.spans = list(zip(np.concatenate(([0], ends[:-1])).tolist(), ends.tolist()))
        low, high = matrix("low").astype(np.float64), matrix("high").astype(np.float64)
        labels = leaves.column("label").to_numpy()
        self.low, self.high, self.labels = list(low), list(high), labels.tolist()
        self.children: list[list[int] | None] = [None] * len(labels)
        self.roots: dict[int, int] = {}
        for label in np.unique(labels).tolist():
            level = np.flatnonzero(labels == label).tolist()
            while len(level) > 1:
                groups = [level[i : i + FANOUT] for i in range(0, len(level), FANOUT)]
                level = []
                for g in groups:
                    level.append(len(self.children))
                    self.children.append(g)
                    self.labels.append(label)
                    self.low.append(np.min([self.low[x] for x in g], axis=0))
                    self.high.append(np.max([self.high[x] for x in g], axis=0))
            self.roots[label] = level[0]
        self.low, self.high = np.array(self.low), np.array(self.high)

    def intervals(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest inner product of each anchor with any vector of each box."""
        up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
        return up @ self.low.T + down @ self.high.T, up @ self.high.T + down @ self.low.T

    def search(
        self, anchor: np.ndarray, least: np.ndarray, most: np.ndarray, roots: list[int], windows: list[tuple[float, float]], k: int, itself: int | None
    ) -> list[list[tuple[float, int]]]:
        """For each window ``(low, high)`` the first ``k`` (-score, id) within it, under
        ``roots``; ``itself``: the id of the anchor's own row, which is left out."""
        found: list[list[tuple[float, int]]] = [[] for _ in windows]
        floor = [low for low, _ in windows]  # a score below it is of no use to the window
        queue = [(-most[r], r) for r in roots]
        heapq.heapify(queue)
        while queue:
            upper, node = heapq.heappop(queue)
            if -upper < min(floor):
                break
            lower = least[node]
            if not any(-upper >= f and lower <= high for f, (_, high) in zip(floor, windows)):
                continue
            if (below := self.children[node]) is not None:
                for c in below:
                    heapq.heappush(queue, (-most[c], c))
                continue
            begin, end = self.spans[node]
            scores = self.vectors[begin:end] @ anchor
            for w, (_, high) in enumerate(windows):
                hits = np.flatnonzero((scores >= floor[w]) & (scores <= high))
                if not len(hits):
                    continue
                own = found[w]
                for h in hits.tolist():
                    id = int(self.ids[begin + h])
                    if id == itself and np.array_equal(self.vectors[begin + h], anchor):
                        continue
                    own.append((-float(scores[h]), id))
                own.sort()
                del own[k:]
                if len(own) == k:
                    floor[w] = max(floor[w], -own[-1][0])
        return found


def _search(leaves: DataFrame, anchors: DataFrame, dims: int, parts: int, blocks: int, k: int, same: bool, low: int, high: int) -> DataFrame:
    """``(anchor, window, score, id)``: up to ``k`` per part.  ``anchors(anchor, id, label,
    q, scores)``: the window for a positive's score ``s`` holds the scores that, times 100,
    lie between ``low * s`` and ``high * s``; without scores, everything is one window."""
    place = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")
    asked = anchors.select((F.col("anchor") % blocks).cast("int").alias("block"), "anchor", "id", "label", "q", "scores", place)
    held = leaves.select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))

    def run(part: pa.Table, block: pa.Table) -> pa.Table:
        out: dict[str, list] = {"anchor": [], "window": [], "score": [], "id": []}
        if part.num_rows and block.num_rows:
            tree = Tree(part, dims)
            numbers, ids, labels = (block.column(c).to_pylist() for c in ("anchor", "id", "label"))
            asked_scores, vectors = block.column("scores").to_pylist(), block.column("q").to_pylist()
            for begin in range(0, len(numbers), 256):
                q = np.zeros((len(numbers[begin : begin + 256]), dims))
                for i, v in enumerate(vectors[begin : begin + 256]):
                    q[i, : len(v)] = v
                least, most = tree.intervals(q)
                for i in range(len(q)):
                    a = begin + i
                    roots = [r for x, r in tree.roots.items() if (x == labels[a]) == same]
                    windows = [(-math.inf, math.inf)]
                    if not same:
                        # Whole scores, so the window's ends are whole too.
                        windows = [(-(-low * s // 100), high * s // 100) for s in asked_scores[a]]
                    for w, hits in enumerate(tree.search(q[i], least[i], most[i], roots, windows, k, ids[a] if same else None)):
                        for score, id in hits:
                            out["anchor"].append(numbers[a])
                            out["window"].append(w)
                            out["score"].append(int(-score))
                            out["id"].append(id)
        return pa.table(out, pa.schema([("anchor", pa.int64()), ("window", pa.int32()), ("score", pa.int64()), ("id", pa.int64())]))

    both = held.groupBy("part", "block").cogroup(asked.groupBy("part", "block"))
    local = both.applyInArrow(run, "anchor long, window int, score long, id long")
    order = Window.partitionBy("anchor", "window").orderBy(F.col("score").desc(), "id")
    return local.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    rows: DataFrame,
    anchors: Column,
    scale: float = 256,
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
    id: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
    part: int = PART,
    block: int = BLOCK,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``anchors`` is a condition on ``id`` and ``label`` (as columns ``id``, ``label``).  A
    row's score is its inner product with the anchor, in the integers of ``integer_rows``;
    higher first, ties by smaller id.  An anchor's positives are its first ``positives`` other
    rows of the same label; for each, its negatives are the first ``negatives`` rows of
    other labels whose score, times 100, lies between ``low`` and ``high`` times the positive's.

    Rows without id or label, with a null vector or a component that is null, NaN,
    infinite or too large take no part.  Rows that agree in id, label and vector are one row;
    rows that share only the id are different ones, and one may be the other's positive.  Of
    vectors of different lengths the missing components count as zero.  Anchors without
    positives, positives without negatives and empty tables give no rows.  A negative
    positive score has no window, unless ``low`` exceeds ``high``.  Other columns are ignored.

    Parts and blocks of anchors hold up to ``part`` and ``block`` rows each, whatever the
    size of the input; every anchor is compared with every part's boxes.
    """
    kept = shared_table(integer_rows(rows, scale, id, label, vector), "vectors")
    size = kept.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("q")).alias("dims")).first()
    n, dims = size["n"], max(1, size["dims"] or 0)
    # Small inputs are cut further, so that all cores have a part.
    cores = kept.sparkSession.sparkContext.defaultParallelism
    leaves = packed(kept, dims, max(1, -(-n // part), min(cores, -(-n // 1024))))
    parts = (leaves.agg(F.max("part")).first()[0] or 0) + 1
    own = kept.where(F.coalesce(anchors, F.lit(False))).distinct().withColumn("anchor", F.monotonically_increasing_id())
    own = shared_table(own.withColumn("scores", F.lit(None).cast("array<bigint>")), "anchors")
    blocks = max(1, -(-own.count() // block))
    best = shared_table(_search(leaves, own, dims, parts, blocks, positives, True, low, high), "positives")
    # At most ``positives`` per anchor.
    listed = best.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("rank", "score", "id"))).alias("p"))
    asking = shared_table(own.drop("scores").join(listed, "anchor").withColumn("scores", F.col("p.score")), "asking")
    hits = _search(leaves, asking.drop("p"), dims, parts, blocks, negatives, False, low, high)
    named = asking.select("anchor", F.col("id").alias("anchor_id"), F.posexplode("p").alias("window", "p"))
    out = hits.join(named, ["anchor", "window"])
    return out.select(
        "anchor_id", F.col("p.id").alias("positive_id"), F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        F.col("p.score").alias("positive_score"), F.col("score").alias("negative_score"),
    )
