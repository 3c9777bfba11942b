import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from ledgerlens.llm.sharding import cut_places, shard


def minimax(sizes, shards):
    def fits(c):
        n, s = 1, 0
        for x in sizes:
            if s + x > c:
                n, s = n + 1, 0
            s += x
        return n <= shards

    lo, hi = max(sizes), sum(sizes)
    while lo < hi:
        mid = (lo + hi) // 2
        lo, hi = (lo, mid) if fits(mid) else (mid + 1, hi)
    return hi


def check(rows, texts, shards):
    groups = defaultdict(int)
    for t in texts:
        groups[hashlib.sha256((t or "").encode()).hexdigest()] += len((t or "").encode()) + 1
    load, slots = defaultdict(int), defaultdict(list)
    for r in rows:
        load[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert max(load.values()) == minimax([groups[k] for k in sorted(groups)], shards)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(load) <= set(range(shards))


def test_documents(documents):
    rows = shard(documents, shards=16).collect()
    text = {r.doc_id: r.text for r in documents.collect()}
    assert len(rows) == len(text)
    check(rows, text.values(), 16)
    for r in rows:
        raw = (text[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32) == (len(raw) + 1, zlib.crc32(raw))
    place = defaultdict(set)
    for r in rows:
        place[text[r.doc_id]].add(r.shard)
    assert all(len(s) == 1 for s in place.values())


def test_odd_rows(odder, odd):
    rows = shard(odder, shards=4).collect()
    assert len(rows) == odd.count()
    check(rows, [r.text for r in odd.collect()], 4)
    assert {r["size"] for r in rows if r.text_crc32 == 0} == {1}


def test_empty(empty):
    assert shard(empty).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_cuts_with_few_buckets(spark, seed):
    """Few buckets force several rounds of refinement."""
    rng = random.Random(seed)
    sizes = [rng.choice([1, 2, 7, 50, 400, 9000 if seed % 2 else 3]) for _ in range(700)]
    ends, at = [], 0
    for s in sizes:
        at += s
        ends.append((at,))
    shards = rng.choice([3, 8, 16])
    cuts = cut_places(spark.createDataFrame(ends, "end long"), at, max(sizes), shards, buckets=8)
    assert len(cuts) == shards and cuts[-1] == at and set(cuts) <= {e for (e,) in ends}
    assert max(b - a for a, b in zip([0, *cuts], cuts)) == minimax(sizes, shards)


def test_even_beside_a_giant(spark):
    """A group over an even share doesn't starve the other shards."""
    sizes = [10] * 500 + [2000] + [10] * 500
    ends, at = [], 0
    for s in sizes:
        at += s
        ends.append((at,))
    cuts = cut_places(spark.createDataFrame(ends, "end long"), at, 2000, 8)
    loads = sorted(b - a for a, b in zip([0, *cuts], cuts))
    assert loads[-1] == 2000 and loads[0] > 0.7 * loads[-2]


@pytest.mark.parametrize("distinct", [1, 2, 3, 15])
def test_fewer_groups_than_shards(spark, distinct):
    """Copies of a few texts: all rows are there, and the last shards stay empty."""
    texts = [f"text {i % distinct}" + " longer" * (i % distinct) for i in range(60)]
    rows = shard(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), shards=16).collect()
    assert sorted(r.doc_id for r in rows) == list(range(60))
    check(rows, texts, 16)
    used = {r.shard for r in rows}
    assert used == set(range(len(used)))
