import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import va_clustering as V


def brute(rows, k, rounds, dims, scale):
    """Every vector against every centroid, in Python integers."""
    kept = []
    for id, v in rows:
        if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v):
            kept.append((id, [int(np.floor(scale * float(x))) for x in v]))
    key = lambda r: ("g" if r[0] is None else hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1])
    cent = [r[1] for r in sorted(kept, key=key)[:k]]

    def place():
        out = []
        for _, q in kept:
            d = [sum((a - b) ** 2 for a, b in zip(q, c)) for c in cent]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        at = place()
        for c in range(len(cent)):
            own = [q for (_, q), (own_c, _) in zip(kept, at) if own_c == c]
            if own:
                cent[c] = [sum(col) // len(own) for col in zip(*own)]
    at = place()
    inertia = [sum(d for c, d in at if c == i) for i in range(len(cent))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cent]
    return sorted(((id, c, d, inertia[c], sum(inertia), sha[c]) for (id, _), (c, d) in zip(kept, at)), key=str)


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def result(df, **args):
    return sorted((tuple(r)[:6] for r in V.cluster(df, **args).collect()), key=str)


@pytest.mark.parametrize("dims, k, scale", [(8, 5, 64), (3, 4, 4), (1, 2, 8), (7, 16, 2)])
def test_equals_brute_force(spark, dims, k, scale):
    """A small scale gives many ties between centroids."""
    rng = np.random.default_rng(dims)
    rows = [(i, rng.normal(size=dims).astype(np.float32).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[i % 7][1]) for i in range(60)]
    assert result(frame(spark, rows).repartition(5), k=k, rounds=3, dims=dims, scale=scale) == brute(rows, k, 3, dims, scale)


def test_odd_rows_and_columns(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (1, [3.0, 4.0]), (None, [5.0, 6.0]), (None, None), (2, None), (3, [1.0]), (4, []), (5, [1.0, 2.0, 3.0]),
            (6, [None, 1.0]), (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [-inf, 1.0]), (10, [-0.5, 1e-30]), (11, [-1e-30, 90.0])]
    df = frame(spark, rows)
    for clash in ("id", "q", "cells", "cluster", "v", "distance"):
        df = df.withColumn(clash, F.lit("clash"))
    df = df.select("*", F.lit("clash").alias("EMBEDDING"))
    assert result(df, k=3, rounds=2, dims=2, scale=64) == brute(rows, 3, 2, 2, 64)
    assert result(df, k=100, rounds=1, dims=2, scale=64) == brute(rows, 100, 1, 2, 64)


def test_too_large_components_count_as_infinite(spark):
    rows = [(1, [1.0]), (2, [3e38]), (3, [2.0])]
    assert [r[0] for r in result(frame(spark, rows), k=2, dims=1)] == [1, 3]


def test_empty_and_nothing_kept(spark):
    out = V.cluster(frame(spark, []))
    assert out.count() == 0
    assert dict(out.dtypes) == {
        "vec_id": "bigint", "cluster": "int", "distance": "bigint", "cluster_inertia": "bigint", "inertia": "bigint", "centroid_sha256": "string",
        "compared": "boolean",
    }
    assert V.cluster(frame(spark, [(1, [1.0])]), dims=64).count() == 0


def test_intervals_hold_the_distances():
    rng = np.random.default_rng(3)
    q = rng.integers(-50, 50, (500, 9))
    high = np.sort(rng.integers(-50, 50, (9, V.CELLS)), axis=1)
    high[:, -1] = 50
    low = np.concatenate((np.full((9, 1), -50), high[:, :-1] + 1), axis=1)
    centroids = rng.integers(-60, 60, (4, 9))
    cells, tables = V.approximate(q, high), V.lookup_tables(low, high, centroids)
    bounds = sum(t[cells[:, b]] for b, t in enumerate(tables))
    exact = ((q[:, None] - centroids) ** 2).sum(axis=2)
    assert (bounds[:, :4] <= exact).all() and (exact <= bounds[:, 4:]).all()
    cluster, overlap = V.assign(cells, q, tables, centroids)
    assert (cluster == exact.argmin(axis=1)).all() and 0 < overlap.mean() < 1


def test_clear_vectors_are_not_compared(spark):
    """Far groups are told apart by their cells alone."""
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=16) * 0.05 + (i % 2) * 10).tolist()) for i in range(400)]
    out = V.cluster(frame(spark, rows), k=2, rounds=2, dims=16)
    assert out.agg(F.avg(F.col("compared").cast("int"))).first()[0] < 0.1 or out.select("cluster").distinct().count() < 2
