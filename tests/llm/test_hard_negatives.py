import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import hard_negatives as N


def brute(rows, scale, anchor, positives=5, negatives=5, low=80, high=100):
    kept = []
    for id, label, v in rows:
        if id is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            r = (id, label, tuple(int(np.floor(scale * float(x))) for x in v))
            if r not in kept:
                kept.append(r)
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for a in kept:
        if not anchor(a[0]):
            continue
        scored = sorted((-dot(a[2], r[2]), r[0], r[1]) for r in kept if r != a)
        for s, pid, _ in [x for x in scored if x[2] == a[1]][:positives]:
            hits = [x for x in scored if x[2] != a[1] and low * -s <= 100 * -x[0] <= high * -s][:negatives]
            out += [(a[0], pid, n, x[1], -s, -x[0]) for n, x in enumerate(hits, 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")


def result(df, every=10, **args):
    return sorted(tuple(r) for r in N.mine(df, F.col("id") % every == 0, **args).collect())


def data(n, dims, labels=4, seed=0, spread=0.5):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(labels, dims))
    which = rng.integers(0, labels, n)
    vectors = (centers[which] * spread + rng.normal(size=(n, dims)) * 0.3).astype(np.float32)
    moved = np.where(np.arange(n) % 7 == 0, (which + 1) % labels, which)
    return [(i, int(moved[i]), vectors[i].tolist()) for i in range(n)]


@pytest.mark.parametrize("dims, scale", [(16, 256), (4, 4), (1, 2)])
def test_equals_brute_force(spark, dims, scale):
    """A small scale gives many ties."""
    rows = data(600, dims, seed=dims)
    got = result(frame(spark, rows).repartition(4), scale=scale)
    assert got == brute(rows, scale, lambda i: i % 10 == 0) and got


def test_many_parts_and_blocks(spark):
    rows = data(400, 6, seed=9)
    assert result(frame(spark, rows), part=50, block=7) == brute(rows, 256, lambda i: i % 10 == 0)


def test_one_label_holds_most_rows(spark):
    rows = [(i, 0 if i % 5 else 1, v) for i, _, v in data(500, 5, seed=2)]
    assert result(frame(spark, rows), part=64) == brute(rows, 256, lambda i: i % 10 == 0)


def test_odd_rows_and_columns(spark):
    nan, inf = float("nan"), float("inf")
    rows = data(60, 3, labels=2, seed=4)
    rows += rows[:25]  # repeated rows
    rows += [(0, 0, [0.5, 0.5, 0.1]), (10, 1, [0.4, 0.4, 0.2])]  # ids with several vectors
    rows += [(200, None, [1.0, 1.0, 1.0]), (210, 1, None), (220, 0, [None, 1.0, 1.0]), (230, 0, [nan, 1.0, 1.0]), (240, 1, [inf, 0.0, 0.0]),
             (None, 1, [0.5, 0.5, 0.5]), (250, 0, []), (260, 1, [0.7]), (270, 0, [0.1, 0.2, 0.3, 0.4])]
    df = frame(spark, rows)
    for clash in ("id", "q", "part", "anchor", "score", "rank", "block", "window"):
        df = df.withColumn(clash, F.lit("clash"))
    df = df.select("*", F.lit("clash").alias("LABEL"))
    assert result(df) == brute(rows, 256, lambda i: i % 10 == 0)


def test_empty_and_lonely(spark):
    out = N.mine(frame(spark, []), F.col("id") % 10 == 0)
    assert out.count() == 0
    assert dict(out.dtypes) == {
        "anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint", "positive_score": "bigint", "negative_score": "bigint",
    }
    assert result(frame(spark, [(0, 1, [1.0]), (1, 2, [1.0])])) == []
    assert result(frame(spark, [(1, 1, [1.0]), (2, 1, [1.0])])) == []  # no anchors


def test_too_large_components_count_as_infinite(spark):
    rows = [(0, 1, [1.0]), (1, 1, [1.0]), (2, 2, [3e38]), (3, 2, [0.9])]
    assert result(frame(spark, rows)) == [(0, 1, 1, 3, 65536, 58880)]


def leaves(q, labels, ids, leaf=8):
    out = {"label": [], "ids": [], "q": [], "low": [], "high": []}
    for label in np.unique(labels):
        own = np.flatnonzero(labels == label)
        for t in N.tiles(q[own], leaf):
            at = own[t]
            for name, value in zip(out, (label, ids[at], q[at].ravel(), q[at].min(axis=0), q[at].max(axis=0))):
                out[name].append(value)
    return pa.table({k: pa.array([x.tolist() for x in v]) for k, v in out.items()})


def test_boxes_bound_the_scores_and_prune():
    rng = np.random.default_rng(5)
    q = np.concatenate([rng.integers(-20, 20, (200, 4)) + c for c in ([90, 0, 0, 0], [0, 90, 0, 0], [-90, 0, 0, 0])])
    labels, ids = np.zeros(600, int), np.arange(600)
    tree = N.Tree(leaves(q, labels, ids), 4)
    anchor = np.array([3.0, 1.0, 0.0, -1.0])
    least, most = tree.intervals(anchor[None])
    for node, below in enumerate(tree.children):
        if below is None:
            b, e = tree.spans[node]
            scores = tree.vectors[b:e] @ anchor
            assert least[0, node] <= scores.min() and scores.max() <= most[0, node]
        else:
            assert all(least[0, node] <= least[0, c] and most[0, c] <= most[0, node] for c in below)

    class Counting(list):
        reads = 0

        def __getitem__(self, i):
            Counting.reads += 1
            return super().__getitem__(i)

    tree.spans = Counting(tree.spans)
    hits = tree.search(anchor, least[0], most[0], [tree.roots[0]], [(-np.inf, np.inf)], 5, None)
    want = sorted((-float(x), int(i)) for i, x in enumerate(q @ anchor))[:5]
    assert hits == [want] and Counting.reads < len(tree.spans) / 3


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 1000, 4097])
def test_tiles_hold_every_row_once(n):
    q = np.random.default_rng(n).integers(-5, 5, (n, 5))
    out = N.tiles(q)
    assert sorted(np.concatenate(out).tolist() if out else []) == list(range(n))
    assert all(0 < len(t) <= N.LEAF for t in out) and len(out) <= 2 * -(-n // N.LEAF)
