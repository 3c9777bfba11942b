import random

import numpy as np
import pyarrow as pa
import pytest

from ledgerlens.llm import masked_lm as M


@pytest.fixture(scope="module")
def corpus(spark):
    """Texts in which every token follows from its neighbours, and shuffled ones."""
    rng = random.Random(1)
    loops = [[f"{a}{k}" for k in range(6)] for a in "abcdefgh"]
    rows = []
    for i in range(400):
        words = [w for _ in range(10) for w in rng.choice(loops)]
        rows.append((i, " ".join(words)))
    for i in range(400, 420):
        words = [w for _ in range(10) for w in rng.choice(loops)]
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4).cache()


@pytest.fixture(scope="module")
def model(corpus):
    vocab = M.vocabulary(corpus)
    return M.fit(corpus, vocab, rounds=3, stride=2), vocab


def test_order_scores_better(corpus, model):
    rows = M.score(corpus, *model).collect()
    plain = np.mean([r.mean_log_probability for r in rows if r.doc_id < 400])
    shuffled = np.mean([r.mean_log_probability for r in rows if r.doc_id >= 400])
    unigram = np.log(1 / 48)
    assert plain > unigram + 1 and plain > shuffled + 1


def test_equals_token_by_token(corpus, model):
    p, vocab = model
    u, c = p[M.OUTPUT : M.BIAS].reshape(M.SIZE, M.CLASSES), p[M.BIAS :].reshape(M.CLASSES)
    for r in M.score(corpus.where("doc_id < 3"), p, vocab).collect():
        text = next(x.text for x in corpus.where(f"doc_id = {r.doc_id}").collect())
        ids = vocab.ids(text.split(), {})
        total = 0.0
        for i, own in enumerate(ids):
            h = np.zeros(M.SIZE)
            for k, d in enumerate(M.PLACES):
                if 0 <= i + d < len(ids):
                    h += p[ids[i + d]].astype(float) * p[M.SCALES + k]
            z = np.tanh(h) @ u + c
            total += z[vocab.classes[own]] - np.log(np.exp(z).sum()) + vocab.inside[own]
        assert r.n_tokens == len(ids) and abs(r.log_likelihood - total) < 1e-3 * abs(total)


def test_gradient_lowers_the_loss(corpus, model):
    _, vocab = model
    trainer = M.Trainer(M.initial(vocab), vocab)
    tokens, places = M.padded([vocab.ids(r.text.split(), {}) for r in corpus.where("doc_id < 60").collect()])
    before = M.log_probabilities(trainer.p, vocab, tokens, places).mean()
    for _ in range(20):
        trainer.learn(tokens, places)
    assert M.log_probabilities(trainer.p, vocab, tokens, places).mean() > before + 0.5


def test_inside_classes_sum_to_one(model):
    _, vocab = model
    assert np.allclose(np.bincount(vocab.classes, np.exp(vocab.inside))[np.unique(vocab.classes)], 1)


def test_vocabulary_counts_every_text(corpus):
    vocab = M.vocabulary(corpus)
    assert sorted(vocab.index) == sorted(f"{a}{k}" for a in "abcdefgh" for k in range(6))


def test_odd_rows(odd, odder, empty):
    rows = M.pseudo_likelihood(odder).collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert (r.n_tokens == 0) == (r.mean_log_probability is None) and np.isfinite(r.log_likelihood)
    same = [r.log_likelihood for r in rows if r.doc_id in (1, 6) and r.n_tokens == 14]
    assert len(same) == 3 and np.ptp(same) < 1e-6
    assert max(r.n_tokens for r in rows) == 30_000
    assert M.pseudo_likelihood(empty).collect() == []


def test_every_place_is_learnt_in_each_round(corpus, model, monkeypatch):
    """Batches hold all tokens, not one place in several; the gradient is that of
    the places taken one by one."""
    _, vocab = model
    seen = []
    monkeypatch.setattr(M.Trainer, "learn", lambda self, tokens, places: seen.append((tokens, places)))
    docs = corpus.where("doc_id < 5")
    monkeypatch.setattr(type(docs), "mapInArrow", lambda df, f, schema: _run_here(df, f, schema))
    M.fit(docs, vocab, rounds=2)
    assert len(seen) == 2
    for tokens, places in seen:
        assert sorted(places) == np.flatnonzero(tokens != M.TOKENS).tolist()


def _run_here(df, f, schema):
    """``f`` over the rows in this process; then a table without rows."""
    import pyarrow as pa

    list(f(iter([pa.RecordBatch.from_pylist([r.asDict() for r in df.collect()])])))
    return df.sparkSession.createDataFrame([], schema)


def test_gradient_by_places(corpus, model):
    """A step on a run equals the sums over its places, also with places left out."""
    _, vocab = model
    tokens, places = M.padded([vocab.ids(r.text.split(), {}) for r in corpus.where("doc_id < 4").collect()])
    places = places[places % 5 != 0]
    trainer = M.Trainer(M.initial(vocab), vocab)
    p, grads = trainer.p.astype(float), {}
    trainer._step = lambda rows, grad: grads.update(zip(rows.tolist(), grad))
    trainer.learn(tokens, places)
    u, c = M._output(p)
    want, times = np.zeros_like(p), np.zeros(len(p))
    for i in places:
        h = np.tanh(sum(p[tokens[i + d]] * p[M.SCALES + k] for k, d in enumerate(M.PLACES)))
        e = np.exp(h @ u + c)
        g = (e / e.sum() - np.eye(M.CLASSES)[vocab.classes[tokens[i]]]) / len(places)
        back = (u @ g) * (1 - h * h)
        for k, d in enumerate(M.PLACES):
            want[tokens[i + d]] += back * p[M.SCALES + k]
            want[M.SCALES + k] += back * p[tokens[i + d]]
            times[tokens[i + d]] += 1
        want[M.OUTPUT : M.BIAS] += np.outer(h, g).reshape(-1, M.SIZE)
        want[M.BIAS :] += g.reshape(-1, M.SIZE)
    want[M.TOKENS] = 0
    assert all(np.allclose(grads[r], want[r], atol=1e-6) for r in grads)
    assert not np.delete(want, sorted(grads), axis=0).any() and (trainer.used[: M.TOKENS] == times[: M.TOKENS]).all()


def test_every_word_counts(spark):
    """Words of one bucket score by their own counts, kept or joined alike; their
    probabilities within the bucket sum to one, and unseen words come last."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(6000) for _ in range(6 if i < M.WORDS else 1 + i % 5)] + ["a\u00a0b"] * 5
    rng.shuffle(words)
    docs = spark.createDataFrame([(i // 50, " ".join(words[i : i + 50])) for i in range(0, len(words), 50)], "doc_id long, text string")
    counts = M.word_counts(docs)
    n = {r.w: r.n for r in counts.collect()}
    assert sum(n.values()) == sum(len(r.text.split()) for r in docs.collect()) and n["a"] == n["b"] == 5
    vocab = M.vocabulary(docs, counts=counts)
    p = M.initial(vocab)
    bucket = {}
    for w in n:
        if w not in vocab.index:
            bucket.setdefault(vocab.ids([w], {})[0], []).append(w)
    same = sorted(max(bucket.values(), key=len), key=lambda w: (-n[w], w))
    new = next(w for k in range(10**6) if (w := f"new{k}") not in n and vocab.ids([w], {}) == vocab.ids(same[:1], {}))
    single = spark.createDataFrame([(i, w) for i, w in enumerate([*same, new])], "doc_id long, text string")
    plain = {r.doc_id: r.log_likelihood for r in M.score(single, p, vocab).collect()}
    assert len({round(v, 6) for v in plain.values()}) == 1  # as their bucket
    for kept in (0, 500, M.KEPT):
        got = {r.doc_id: r.log_likelihood for r in M.score(single, p, vocab, counts=counts, kept=kept).collect()}
        share = {i: np.exp(got[i] - plain[i]) for i in got}
        of = sum(n[w] for w in same)
        assert all(abs(share[i] - n[w] / of) < 1e-6 for i, w in enumerate(same))
        assert abs(share[len(same)] - 0.5 / of) < 1e-6
        whole = {r.doc_id: r for r in M.score(docs, p, vocab, counts=counts, kept=kept).collect()}
        base = {r.doc_id: r for r in M.score(docs, p, vocab).collect()}
        for r in docs.where("doc_id < 5").collect():
            ids = vocab.ids(r.text.split(), {})
            more = sum(np.log(n[w] / vocab.rare[i - M.WORDS]) for w, i in zip(r.text.split(), ids) if i >= M.WORDS)
            assert abs(whole[r.doc_id].log_likelihood - base[r.doc_id].log_likelihood - more) < 1e-6


def test_words_split_as_str_split():
    """Every character separates words, or does not, as ``str.split`` has it."""
    texts = [f"a{chr(c)}b" for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    words, n = M.split(pa.array([t.encode() for t in texts], pa.binary()))
    assert n.tolist() == [len(t.split()) for t in texts] and words.to_pylist() == [w for t in texts for w in t.split()]
    odd = [b"", None, b" ", b"a", b" a  b ", "\u00e9 b\n".encode(), b"a a"]
    for rows in (odd, [*odd, b"\xff x \xc3"], odd[:3], []):
        words, n = M.split(pa.array(rows, pa.binary()))
        want = [M._words(r) for r in rows]
        assert n.tolist() == list(map(len, want)) and words.to_pylist() == [w for t in want for w in t]


def test_counts_handed_on_in_parts(corpus):
    whole = {r.w: r.n for r in M.word_counts(corpus).collect()}
    assert {r.w: r.n for r in M.word_counts(corpus, held=50).collect()} == whole


def test_batches_gathered():
    """Every row once and in order; no look-up of more than ``held`` bytes but a single batch."""
    batches = [pa.RecordBatch.from_pydict({"doc_id": [i, i], "_text": [b"x" * n, None]}) for i, n in enumerate((10, 20, 900, 30, 5, 5))]
    got = list(M.gathered(iter(batches), held=300))
    assert pa.Table.from_batches(got).equals(pa.Table.from_batches(batches))
    assert 1 < len(got) < len(batches) and all(b.nbytes <= 300 or b.num_rows == 2 for b in got)
    assert list(M.gathered(iter([]))) == []


def test_kept_words_are_hashed_once_for_many_batches(spark, monkeypatch):
    """A small batch of texts costs no hashing of all kept words of its own."""
    docs = spark.createDataFrame([(i, f"a b c{i}") for i in range(3000)], "doc_id long, text string").coalesce(1)
    counts = M.word_counts(docs)
    vocab = M.vocabulary(docs, counts=counts)
    real, seen = M.pc.index_in, []
    monkeypatch.setattr(M.pc, "index_in", lambda *args: seen.append(1) or real(*args))
    made = []

    def in_small_batches(df, f, schema):
        rows = [r.asDict() for r in df.collect()]
        made.extend(f(pa.RecordBatch.from_pylist(rows[i : i + 512]) for i in range(0, len(rows), 512)))
        return df.sparkSession.createDataFrame([], schema)

    monkeypatch.setattr(type(docs), "mapInArrow", in_small_batches)
    M.token_table(docs, vocab, counts=counts)
    assert len(seen) == 1 and sum(b.num_rows for b in made) == 3000


def test_words_to_join_are_not_scored_along(spark):
    """The scoring step reads no words: they are joined from the written table."""
    docs = spark.createDataFrame([(i % 3, f"a b c{i}") for i in range(50)] + [(None, None)], "doc_id long, text string")
    counts = M.word_counts(docs)
    vocab = M.Vocabulary({"a": 0}, *M.classes(np.ones(M.TOKENS)), np.ones(M.BUCKETS))
    given = M.token_table(docs, vocab, counts=counts, kept=0)
    rows = M.shared_table(given[0], "tokens")
    assert rows.select("_row").distinct().count() == 51
    got = M.score(docs, M.initial(vocab), vocab, counts=counts, kept=0, tokens=(rows, given[1]))
    assert got.columns == ["doc_id", "n_tokens", "log_likelihood", "mean_log_probability"]
    again = M.score(docs, M.initial(vocab), vocab, counts=counts, kept=0)
    key = lambda r: (r.doc_id is None, r.doc_id, round(r.log_likelihood, 9))
    assert sorted(map(key, got.collect()), key=str) == sorted(map(key, again.collect()), key=str)
