import random
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerlens.llm.components import connected_components
from ledgerlens.llm.simhash import _signed, fingerprint, keep_one, links, masks, near_duplicates, stars


def plain(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(fps, radius=3):
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(parent, 2):
        if (a ^ b).bit_count() <= radius:
            parent[find(a)] = find(b)
    return {f: find(f) for f in parent}


@pytest.mark.parametrize("text", [None, "", " \n", "One", "a B", "É É é", "Aa bb CC aa BB cc aa", "x " * 70_000])
def test_fingerprint(text):
    assert fingerprint(None if text is None else text.encode()) == plain(text)


@pytest.mark.parametrize("radius,level", [(1, 0), (2, 0), (3, 0), (3, 1), (3, 5)])
def test_masks_cover(radius, level):
    """Every set of up to ``radius`` bits is outside some mask."""
    tables = masks(radius, level)
    assert len(tables) == 2 ** (radius + 1) - 1
    for bits in combinations(range(64), radius):
        flips = sum(1 << b for b in bits)
        assert any(not m & flips for m in tables)


def test_levels_shrink_buckets():
    """Free bits of any chain of tables fall with each level, so splitting ends."""
    free = [(1 << 64) - 1]
    worst = []
    for level in range(4):
        free = [f & ~m & (1 << 64) - 1 for f in free for m in masks(3, level)]
        worst.append(max(f.bit_count() for f in free))
    assert worst == sorted(worst, reverse=True) and worst[-1] <= 12


def near(rng, base, n, flips):
    return {base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, flips))) for _ in range(n)}


@pytest.mark.parametrize("bucket_rows", [4096, 16])
def test_links_lose_nothing(spark, bucket_rows):
    rng = random.Random(5)
    fps = {rng.getrandbits(64) for _ in range(300)}
    for _ in range(3):
        fps |= near(rng, rng.getrandbits(64), 30, 3)
    distinct = spark.createDataFrame([(_signed(f),) for f in fps], "fp long")
    got = {r.node: r.root for r in connected_components(links(distinct, 3, bucket_rows)).collect()}
    want = roots(fps)
    classes = {}
    for f in fps:
        classes.setdefault(want[f], set()).add(_signed(f))
    for group in classes.values():
        assert {got.get(f, f) for f in group} == {min(group)}


def test_stars_span_groups():
    rng = random.Random(1)
    fps = near(rng, 77, 60, 2) | {rng.getrandbits(64) for _ in range(50)}
    edges = stars(np.array(sorted(fps), np.uint64), 3)
    linked = {x & (1 << 64) - 1 for e in edges for x in e}
    want = roots(fps)
    assert linked == {f for f in fps if sum(v == want[f] for v in want.values()) > 1}


def test_components_of_a_chain(spark):
    chain = [(i, i + 1) for i in range(0, 200)] + [(500, 501), (501, 500), (7, 7), (900, 900)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, 500: 500, 501: 500}


def test_documents(documents):
    text = {r.doc_id: r.text for r in documents.collect()}
    fps = {i: plain(t) for i, t in text.items()}
    want = roots(set(fps.values()))
    least = {}
    for i, f in fps.items():
        least[want[f]] = min(i, least.get(want[f], i))
    rows = near_duplicates(documents).collect()
    assert len(rows) == len(text)
    for r in rows:
        assert (r.fp & (1 << 64) - 1, r.component_id) == (fps[r.doc_id], least[want[fps[r.doc_id]]])
    assert {r.doc_id for r in keep_one(documents).collect()} == set(least.values())


def test_odd_rows(odd, odder):
    rows = near_duplicates(odder).collect()
    assert len(rows) == odd.count()
    by = {(r.doc_id, r.fp): r.component_id for r in rows}
    assert by[(2, 0)] == by[(3, 0)] == by[(4, 0)] == by[(None, 0)] == 2  # no words: linked like any other
    kept = keep_one(odd)
    assert kept.columns == odd.columns
    ids = sorted((r.doc_id or 0, r.text or "") for r in kept.collect())
    assert [i for i, _ in ids] == [0, 1, 1, 2, 5, 7]  # equal rows of one id stay once


def test_empty(empty):
    assert near_duplicates(empty).collect() == [] and keep_one(empty).collect() == []


def test_null_ids_only(spark):
    df = spark.createDataFrame([(None, "a b c"), (None, "a b c")], "doc_id long, text string")
    assert [r.component_id for r in near_duplicates(df).collect()] == [None, None]
    assert keep_one(df).select(F.count("*").alias("n")).first().n == 1
