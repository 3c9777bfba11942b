import random
import re

import pytest

from ledgerlens.llm import decontamination as D
from ledgerlens.llm.decontamination import FRAME, MASKS, SHARE, SPAN, drop_contaminated, overlaps


def words(text):
    return [w for w in re.split(r"[^\w]|_", (text or "").lower()) if w]


def plain(docs, items):
    """Every text against every item by the same masks and frames, pair by pair."""
    out = {}
    places = [[k for k, c in enumerate(m) if c == "1"] for m in MASKS]
    for d, text in docs:
        w = words(text)
        for i, item in items:
            b = words(item)
            frames = {}
            if D.SHORTEST <= len(b) < SPAN:
                for p in range(len(w) - len(b) + 1):
                    if w[p : p + len(b)] == b:
                        frames[(p, tuple(b))] = len(b)
            for at in range(len(b) - SPAN + 1):
                n = min(FRAME, len(b))
                begin = max(0, min(at - (FRAME - SPAN) // 2, len(b) - n))
                for p in range(len(w) - SPAN + 1):
                    if any(all(w[p + k] == b[at + k] for k in ks) for ks in places):
                        start = p + begin - at
                        equal = [0 <= start + k < len(w) and w[start + k] == b[begin + k] for k in range(n)]
                        in_a_row = any(all(equal[k : k + D.RUN]) for k in range(n - D.RUN + 1))
                        if 100 * sum(equal) >= SHARE * n or in_a_row:
                            frames[(start, tuple(b[begin : begin + n]))] = sum(equal)
            if frames:
                out[(d, i)] = (len(frames), max(frames.values()))
    return out


def random_case(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([5, 9, 10, 14, 40])))) for i in range(12)]
    docs = []
    for d in range(40):
        text = rng.choices(vocabulary, k=rng.randint(0, 60))
        if d % 2:
            part = items[rng.randrange(len(items))][1].split()
            part = [w if rng.random() > 0.1 else "changed" for w in part[: rng.choice([12, 30, 99])]]
            text[3:3] = part
        docs.append((d, "  ".join(w.upper() if rng.random() < 0.2 else w + rng.choice(["", ",", "."]) for w in text)))
    return docs, items


@pytest.mark.parametrize("bound", [D.BROADCAST_SEEDS, 0])
def test_equals_pairwise(spark, monkeypatch, bound):
    """The same with broadcast seeds and with shuffled ones."""
    monkeypatch.setattr(D, "BROADCAST_SEEDS", bound)
    docs, items = random_case(1)
    a, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item): (r.n_frames, r.best) for r in overlaps(a, b).collect()}
    want = plain(docs, items)
    assert got == want and len(want) > 5
    dirty = {d for d, _ in want}
    assert {r.doc_id for r in drop_contaminated(a, b).collect()} == {d for d, _ in docs} - dirty


def test_short_items_and_partial_passages(spark):
    """A verbatim eight-word item, and ten to fifteen words in a row of a longer one; fewer
    words in a row, a changed word of a short item and items of a few words find nothing."""
    long = [f"v{k}" for k in range(40)]
    items = [(1, "one two three four five six seven eight"), (2, " ".join(long)), (3, "ordinary language words"), (4, "Four words, that match.")]
    docs = [
        (1, "before ONE two, three four five six seven eight after"), (2, "one two three four five six seven other"),
        *((10 + n, "x y z " + " ".join(long[7 : 7 + n]) + " u v w") for n in range(6, 16)),
        (30, "some ordinary language words here"), (31, "four words that match"), (32, "four words that"),
    ]
    a, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = {(1, 1), (31, 4), *((10 + n, 2) for n in range(10, 16))}
    for bound in (D.BROADCAST_BYTES, 0):
        D.BROADCAST_BYTES, kept = bound, D.BROADCAST_BYTES
        try:
            assert {(r.doc_id, r.item) for r in overlaps(a, b).collect()} == want
        finally:
            D.BROADCAST_BYTES = kept


def test_whole_texts_are_not_shuffled(documents, spark):
    """Below the bound the exchanges hold hits only."""
    items = spark.createDataFrame([(1, " ".join("abcdefghijklmnop"))], "item_id long, text string")
    plan = overlaps(documents, items)._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        if "Exchange hashpartitioning" in line:
            assert "text" not in line and "_w" not in line
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_substituted_passages_are_found(spark):
    rng = random.Random(9)
    items = [(i, " ".join(f"v{rng.randrange(900)}" for _ in range(30))) for i in range(30)]
    docs = []
    for i, text in items:
        w = text.split()
        for at in rng.sample(range(30), 3):
            w[at] = "other"
        docs.append((i, "before the passage " + " ".join(w) + " and after"))
    a, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert {(r.doc_id, r.item) for r in overlaps(a, b).collect()} >= {(i, i) for i in range(30)}


def test_benchmark_passages(spark):
    """Every text that holds ten words of an item in a row is found, no other."""
    sf = "/root/testdata/sf0.001"
    docs, items = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    grams = {}
    for r in items.collect():
        w = words(r.text)
        for k in range(len(w) - 9):
            grams.setdefault(tuple(w[k : k + 10]), set()).add(r.item_id)
    want = set()
    for r in docs.collect():
        w = words(r.text)
        for k in range(len(w) - 9):
            want |= {(r.doc_id, i) for i in grams.get(tuple(w[k : k + 10]), ())}
    assert {(r.doc_id, r.item) for r in overlaps(docs, items).collect()} == want


def test_odd_rows(spark, odd, odder, empty):
    passage = " ".join(f"p{k}" for k in range(20))
    items = spark.createDataFrame([(1, passage), (1, passage), (2, None), (3, ""), (None, passage)], "item_id long, text string")
    planted = odd.unionByName(odd.where("doc_id = 2").limit(1).selectExpr(*[f"'{passage}' text" if c == "text" else c for c in odd.columns]))
    got = sorted((r.doc_id, r.item or 0) for r in overlaps(planted, items).collect())
    assert got == [(2, 0), (2, 1)]
    kept = drop_contaminated(planted, items)
    assert kept.columns == odd.columns and kept.count() == odd.count()
    assert overlaps(odder, items).collect() == []
    assert overlaps(empty, items).collect() == [] and overlaps(planted, items.limit(0)).collect() == []
    assert drop_contaminated(planted, items.limit(0)).count() == odd.count() + 1


def test_no_python_in_the_plan(documents, spark):
    items = spark.createDataFrame([(1, " ".join("abcdefghijklmnop"))], "item_id long, text string")
    plan = overlaps(documents, items)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
