import random

from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.llm.queries import tokenizer_path
from ledgerlens.llm.token_counts import Automaton, sentencepiece_vocabulary, token_counts


def greedy(word, first, rest, longest=64):
    at = n = 0
    while at < len(word):
        pieces = rest if at else first
        end = next((e for e in range(min(len(word), at + longest), at, -1) if word[at:e] in pieces), None)
        if end is None:
            return None
        at, n = end, n + 1
    return n


letters = st.text("abc", min_size=1, max_size=5)


@settings(max_examples=500, deadline=None)
@given(st.sets(letters, max_size=14), st.sets(letters, max_size=14), st.text("abcd", min_size=1, max_size=14))
def test_automaton_equals_greedy(first, rest, word):
    assert Automaton(first, rest).count(word) == greedy(word, first, rest)


def test_linear_on_long_words():
    automaton = Automaton({"a" * k for k in (1, 50)}, {"a" * k for k in (1, 50)})
    assert automaton.count("a" * 100_000) == 2000


def test_documents(spark, documents, odd, odder, empty):
    first, rest = sentencepiece_vocabulary(tokenizer_path("piece_bpe_32k.model"))
    one, two = set(first), set(rest)
    for df, source in ((documents, documents), (odder, odd)):
        got = sorted((r.doc_id or 0, r.n_words, r.n_tokens, r.n_unknown) for r in token_counts(df, first, rest).collect())
        want, known = [], {}
        for r in source.collect():
            words = (r.text or "").encode().split()
            for w in set(words).difference(known):
                known[w] = greedy(w.decode(), one, two)
            counts = [known[w] for w in words]
            want.append((r.doc_id or 0, len(words), sum(c or 1 for c in counts), sum(c is None for c in counts)))
        assert got == sorted(want)
    assert token_counts(empty, first, rest).collect() == []


def test_small_memory_counts_alike(documents):
    first, rest = sentencepiece_vocabulary(tokenizer_path("piece_bpe_32k.model"))
    rows = [sorted(token_counts(documents, first, rest, kept=k).collect()) for k in (10, 500_000)]
    assert rows[0] == rows[1]


def test_random_vocabulary():
    rng = random.Random(4)
    for _ in range(200):
        pieces = {"".join(rng.choice("xy") for _ in range(rng.randint(1, 6))) for _ in range(8)} | {"x", "y"}
        word = "".join(rng.choice("xy") for _ in range(60))
        assert Automaton(pieces, pieces).count(word) == greedy(word, pieces, pieces)


def test_bytes_that_are_no_utf8(spark):
    """They count as the replacement character, which the vocabulary can't spell."""
    df = spark.sql("SELECT 1L AS doc_id, cast(X'6120FF2062' AS string) AS text")
    r = token_counts(df, ["a", "b"], ["a", "b"]).first()
    assert (r.n_words, r.n_unknown) == (3, 1)
