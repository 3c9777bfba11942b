"""Centroid clustering of integer vectors over a VA-file.

Every vector is approximated by a few bits per dimension: the number of the cell,
between quantiles of that dimension, that holds its component.  For a set of centroids,
lookup tables give the least and the greatest squared distance that a cell allows; the
sums over all dimensions bound the distance of a vector to each centroid.  Where one
centroid's greatest distance lies below every other's least one the vector is assigned
by its approximation alone.  Full vectors are compared only where intervals overlap, and
only with the centroids whose intervals do.

Two dimensions share a byte, so a table is read once for two of them.  All arithmetic is
exact, in integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from ledgerlens.llm.common import narrow, shared_table

BITS = 4
CELLS = 1 << BITS
# Components that are this large after scaling cannot be compared in 64-bit integers.
LIMIT = 1 << 26


def integer_vectors(vectors: DataFrame, dims: int, scale: float, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(id, q)`` of the vectors with exactly ``dims`` components, none null, NaN or
    infinite: ``q`` is ``floor(scale * x)`` of each.  A component of 2^26 or more in size
    after scaling is too large for exact distances and counts as infinite."""
    rows = narrow(vectors, id, vector).select(F.col(id).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    fits = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x * F.lit(float(scale))) < LIMIT), F.lit(False)))
    rows = rows.where(F.coalesce(F.size("v") == dims, F.lit(False)) & fits)
    return rows.select("id", F.transform("v", lambda x: F.floor(x * F.lit(float(scale))).cast("int")).alias("q"))


def first_centroids(rows: DataFrame, k: int, salt: str) -> list[list[int]]:
    """The ``k`` vectors (all, if fewer) with the smallest hexadecimal SHA-256 of
    ``salt`` and their id in decimal; ties (repeated ids) by components, null ids last."""
    key = F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256)
    best = rows.select(key.alias("key"), "q").orderBy(F.col("key").asc_nulls_last(), "q").limit(k)
    return [list(r["q"]) for r in best.collect()]  # k rows


def cell_edges(rows: DataFrame, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest component of each cell, both ``(dims, CELLS)``.  Cells lie
    between approximate quantiles over all vectors; any edges give right results."""
    q = [F.col("q")[d] for d in range(dims)]
    inner = [(c + 1) / CELLS for c in range(CELLS - 1)]
    one = rows.agg(
        F.array(*[F.min(x) for x in q]).alias("least"),
        F.array(*[F.max(x) for x in q]).alias("most"),
        F.array(*[F.percentile_approx(x, inner, 1000) for x in q]).alias("upper"),
    ).first()
    least, most, upper = (np.array(one[c], np.int64) for c in ("least", "most", "upper"))
    low = np.concatenate((least[:, None], upper + 1), axis=1)
    high = np.concatenate((upper, most[:, None]), axis=1)
    return low, high


def approximate(q: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Cells of ``(n, dims)`` vectors, two to a byte: ``(n, ceil(dims / 2))``."""
    cells = np.zeros((len(q), q.shape[1] + q.shape[1] % 2), np.uint8)
    for d in range(q.shape[1]):
        cells[:, d] = np.searchsorted(high[d, :-1], q[:, d])
    return cells[:, ::2] | (cells[:, 1::2] << BITS)


def lookup_tables(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """``(bytes, 256, 2 k)``: for each byte of an approximation the least, then the
    greatest, squared distance of its two components to each of the ``k`` centroids."""
    c = centroids.T[:, None, :]  # dims x 1 x k
    below, above = low[:, :, None] - c, c - high[:, :, None]
    least = np.maximum(np.maximum(below, above), 0) ** 2
    most = np.maximum(np.abs(below), np.abs(above)) ** 2
    both = np.concatenate((least, most), axis=2)
    if len(both) % 2:
        both = np.concatenate((both, np.zeros_like(both[:1])))
    byte = np.arange(CELLS * CELLS)
    return both[0::2][:, byte % CELLS] + both[1::2][:, byte // CELLS]


def assign(cells: np.ndarray, q: np.ndarray, tables: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each vector (ties: the smaller number), and whether its
    full components were needed to tell."""
    k = len(centroids)
    bounds = np.zeros((len(cells), 2 * k), np.int64)
    for b, table in enumerate(tables):
        bounds += table[cells[:, b]]
    near = bounds[:, :k] <= bounds[:, k:].min(axis=1, keepdims=True)
    cluster = near.argmax(axis=1)
    overlap = near.sum(axis=1) > 1
    at = np.flatnonzero(overlap)
    exact = np.full((len(at), k), np.iinfo(np.int64).max)
    for c in range(k):
        own = np.flatnonzero(near[at, c])
        exact[own, c] = ((q[at[own]].astype(np.int64) - centroids[c]) ** 2).sum(axis=1)
    cluster[at] = exact.argmin(axis=1)
    return cluster, overlap


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _bytes(column: pa.Array, width: int) -> np.ndarray:
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, np.uint8).reshape(-1, width)


def va_file(rows: DataFrame, dims: int, low: np.ndarray, high: np.ndarray) -> DataFrame:
    """``(id, cells, q)``, written to the shared folder: approximations and vectors."""
    schema = StructType([*rows.schema.fields, StructField("cells", BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cells = approximate(_matrix(b.column("q"), dims), high)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([c.tobytes() for c in cells], pa.binary())], names=schema.names)

    return shared_table(rows.mapInArrow(run, schema), "va-file")


def totals(file: DataFrame, dims: int, low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Number and componentwise sum of each centroid's vectors.  A task adds up its own
    and hands on one row per centroid."""
    k, width = len(centroids), -(-dims // 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = lookup_tables(low, high, centroids)
        n, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for b in batches:
            q = _matrix(b.column("q"), dims)
            cluster, _ = assign(_bytes(b.column("cells"), width), q, tables, centroids)
            n += np.bincount(cluster, minlength=k)
            for c in np.unique(cluster):
                sums[c] += q[cluster == c].sum(axis=0, dtype=np.int64)
        own = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(own, pa.int32()), pa.array(n[own]), pa.array(list(sums[own]), pa.list_(pa.int64()))], names=["cluster", "n", "sums"]
        )

    parts = file.select("q", "cells").mapInArrow(run, "cluster int, n long, sums array<bigint>")
    exact = [F.sum(F.col("sums")[d].cast("decimal(38,0)")) for d in range(dims)]
    whole = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*exact).alias("sums"))
    return {r["cluster"]: (r["n"], [int(x) for x in r["sums"]]) for r in whole.collect()}  # k rows


def cluster(
    vectors: DataFrame,
    k: int = 16,
    rounds: int = 3,
    dims: int = 64,
    scale: float = 64,
    salt: str = "1:",
    id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """``(id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` per vector
    that ``integer_vectors`` keeps.

    Each of ``rounds`` rounds assigns all vectors and moves each centroid that has any to
    the floor of their mean; then they are assigned once more.  Equally near centroids:
    the smaller number.  Repeated rows are vectors of their own; with fewer vectors than
    ``k`` there are fewer centroids; without any, and for an empty table, no rows.  Null
    ids pass through.  An inertia beyond 64 bits is null.  Other columns are ignored.

    The approximations are made once and written with the vectors to the shared folder;
    a round is one pass without a shuffle of vectors.  The driver holds the centroids, the
    cells' edges and one sum per centroid.
    """
    rows = integer_vectors(vectors, dims, scale, id, vector)
    centroids = first_centroids(rows, k, salt)
    if not centroids:
        centroids, low, high = [[0] * dims], np.zeros((dims, CELLS), np.int64), np.zeros((dims, CELLS), np.int64)
    else:
        low, high = cell_edges(rows, dims)
    file, k, width = va_file(rows, dims, low, high), len(centroids), -(-dims // 2)
    for _ in range(rounds):
        for c, (n, sums) in totals(file, dims, low, high, np.array(centroids, np.int64)).items():
            centroids[c] = [s // n for s in sums]
    last = np.array(centroids, np.int64)
    schema = file.select("id").schema.add("cluster", "integer").add("distance", "long").add("compared", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = lookup_tables(low, high, last)
        for b in batches:
            q = _matrix(b.column("q"), dims)
            own, overlap = assign(_bytes(b.column("cells"), width), q, tables, last)
            distance = ((q.astype(np.int64) - last[own]) ** 2).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(own, pa.int32()), pa.array(distance), pa.array(overlap)], names=schema.names
            )

    placed = shared_table(file.mapInArrow(run, schema), "clusters")
    per = placed.groupBy("cluster").agg(F.try_sum("distance").alias("inertia")).collect()  # k rows
    inertia = {r["cluster"]: r["inertia"] for r in per}
    whole = None if None in inertia.values() else sum(inertia.values())
    facts = [
        (c, inertia.get(c), whole if whole is not None and whole < 1 << 63 else None, centroid_sha256(centroids[c])) for c in range(k)
    ]
    named = vectors.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    out = placed.join(F.broadcast(named), "cluster")  # k rows
    return out.select(F.col("id").alias(id), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "compared")


def centroid_sha256(centroid: Sequence[int]) -> str:
    return hashlib.sha256(",".join(str(int(x)) for x in centroid).encode()).hexdigest()
