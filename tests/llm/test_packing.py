import random
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from ledgerlens.llm.packing import Encoder, best_fit, pack, pack_documents, plan, reduce_instance, slots
from ledgerlens.llm.queries import tokenizer_path


def optimum(sizes, capacity):
    """Fewest sequences, by exhaustive search over small instances."""
    sizes = sorted(sizes, reverse=True)
    best = len(sizes)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(sizes):
            best = len(rooms)
            return
        for room in {r for r in rooms if r >= sizes[i]}:
            k = rooms.index(room)
            place(i + 1, rooms[:k] + [room - sizes[i]] + rooms[k + 1 :])
        place(i + 1, rooms + [capacity - sizes[i]])

    place(0, [])
    return best


@pytest.mark.parametrize("seed", range(60))
def test_reduction_keeps_the_optimum(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 12, 20])
    sizes = [rng.randint(1, capacity) for _ in range(rng.randint(1, 9))]
    fixed, rest = reduce_instance(Counter(sizes), capacity)
    assert Counter(sizes) == Counter({k: n for k, n in rest.items()}) + sum(
        (Counter({s: times * c.count(s) for s in set(c)}) for c, times in fixed), Counter()
    )
    assert all(sum(c) <= capacity for c, _ in fixed)
    left = [s for s, n in rest.items() for _ in range(n)]
    assert sum(t for _, t in fixed) + optimum(left, capacity) == optimum(sizes, capacity)


@pytest.mark.parametrize("seed", range(10))
def test_best_fit_equals_item_by_item(seed):
    rng = random.Random(seed)
    sizes = [rng.randint(1, 30) for _ in range(200)]
    rooms = []
    for s in sorted(sizes, reverse=True):
        fit = [r for r in rooms if r >= s]
        if fit:
            rooms.remove(min(fit))
        rooms.append((min(fit) if fit else 30) - s)
    assert Counter(30 - sum(c) for c, n in best_fit(Counter(sizes), 30) for _ in range(n)) == Counter(rooms)


def test_plan_size_follows_the_capacity():
    """A million times the pieces, the same number of patterns or a few more."""
    rng = random.Random(0)
    counts = {s: rng.randint(1, 500) for s in range(1, 257)}
    many = plan({s: n * 1_000_000 for s, n in counts.items()}, 256)
    assert len(many) < 4 * 256 and len(slots(many)) < 256 * 40
    total = sum(s * n for s, n in counts.items()) * 1_000_000
    assert sum(n for _, n in many) <= 1.01 * -(-total // 256)


def laid_out(rows, capacity):
    at = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at.get(r.sequence_id, 0)
        at[r.sequence_id] = r.offset + r.length
    assert max(at.values(), default=0) <= capacity
    return len(at)


def test_pack_numbers_pieces(spark):
    df = spark.range(5000).selectExpr("id", "if(id % 3 = 0, 7L, 1 + id * 31 % 50) length", "id offset_", "'x' _row").repartition(7)
    rows = pack(df, 50).collect()
    assert {r.id for r in rows} == set(range(5000))
    assert laid_out(rows, 50) <= 1.01 * -(-sum(r.length for r in rows) // 50) + 1


def test_bad_lengths(spark):
    with pytest.raises(ValueError):
        pack(spark.createDataFrame([(0,)], "length long"), 8)


@pytest.fixture(scope="module")
def encoder():
    return Encoder(tokenizer_path())


def test_encoder_equals_the_tokenizer(encoder, documents):
    assert encoder.ranks is not None
    rng = random.Random(2)
    letters = "abé 'sßñ \n\t.,19|%Жя  \u0085\x1c\x0b漢😀ll"
    texts = [r.text or "" for r in documents.collect()]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(3000)]
    texts += ["", " ", "x" * 3000, " " * 3000, "<|endoftext|> a", "\n" * 700 + "a"]
    for t in texts:
        assert encoder.encode(t) == np.array(encoder.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes()


def test_other_tokenizers(documents):
    own = Encoder(tokenizer_path("word_bpe_49k.json"))
    assert own.ranks is None and len(own.encode("Some words")) % 4 == 0


def check(rows, docs, encoder):
    pieces = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, r.ids_crc32))
    for i, text in docs.items():
        ids = encoder.encode(text or "") + np.array([2], "<u4").tobytes()
        n, want, at = len(ids) // 4, [], 0
        first = n % 1024 or 1024
        while at < n:
            size = first if not at else 1024
            want.append((len(want), at, size, zlib.crc32(ids[4 * at : 4 * (at + size)])))
            at += size
        assert sorted(pieces[i]) == want


def test_documents(documents, encoder):
    rows = pack_documents(documents, tokenizer_path()).collect()
    check(rows, {r.doc_id: r.text for r in documents.collect()}, encoder)
    bound = -(-sum(r.length for r in rows) // 1024)
    assert laid_out(rows, 1024) <= 1.02 * bound + 1


def test_odd_rows(odder, odd, empty, encoder):
    rows = pack_documents(odder, tokenizer_path()).collect()
    laid_out(rows, 1024)
    docs = {r.doc_id: r.text for r in odd.collect() if r.doc_id not in (1, None)}
    check([r for r in rows if r.doc_id in docs], docs, encoder)
    assert sum(r.piece == 0 for r in rows) == odd.count()
    assert pack_documents(empty, tokenizer_path()).collect() == []


def test_combinations_fit():
    for c, _ in plan(Counter(a + b for a, b in combinations(range(1, 9), 2)), 16):
        assert sum(c) <= 16
