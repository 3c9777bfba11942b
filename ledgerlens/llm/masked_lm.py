"""Masked pseudo-likelihood: every token is predicted from both of its sides.

A small network reads the ``WINDOW`` tokens on either side of a masked place: their
embeddings, scaled per place, are summed, pass a tanh, and a softmax gives the
class of the masked token; the token within its class follows the corpus's counts.
A text's score is the sum of its tokens' conditional log-probabilities.

Tokens are lower-cased words: the ``WORDS`` most frequent of all texts, and
``BUCKETS`` hash buckets for all others.  A word of a bucket adds the logarithm of
its own share of the bucket's counts, so every word of the corpus has a probability
of its own.  Counts cover every text and every word, in a written table.  Training is
data-parallel: in each round every task starts from the shared parameters, takes
gradient steps in numpy over every place of its own texts, and the rows it changed
are averaged over all tasks in one aggregation.  So every token is predicted in
every round, while the driver only sees the model, whose size is fixed.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, ShortType, StringType, StructField, StructType

from ledgerlens.llm.common import narrow, shared_table, small_batches

WORDS, BUCKETS = 3840, 256
TOKENS = WORDS + BUCKETS
WINDOW, SIZE, CLASSES = 3, 32, 64
ROUNDS, BATCH = 2, 4096
# Units that a step sums at once: their columns of a batch stay in a core's cache.
GROUP = 8
# Words whose counts every task holds; all others are joined from the table.  A word
# beyond them has at most about 1 in KEPT of all tokens, so no key of the join is hot.
KEPT = 200_000
# Bytes of texts whose words are looked up at once: each look-up hashes the kept words anew.
GATHERED = 8 << 20
PLACES = [k for k in range(-WINDOW, WINDOW + 1) if k]
# One matrix holds all parameters, so that they average alike: an embedding per
# token and one for padding, a scale per place, two rows of half the output per
# unit, and two of its bias.
SCALES = TOKENS + 1
OUTPUT = SCALES + len(PLACES)
BIAS = OUTPUT + 2 * SIZE
PARAMETERS = BIAS + 2


@dataclass
class Vocabulary:
    index: dict[str, int]  # frequent words
    classes: np.ndarray  # class of each token
    inside: np.ndarray  # log-probability of each token within its class
    rare: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS))  # count of each bucket

    def ids(self, words: list[str], known: dict[str, int]) -> list[int]:
        """Tokens of words; ``known`` keeps what was looked up."""
        for w in set(words).difference(known):
            at = self.index.get(w)
            known[w] = WORDS + zlib.crc32(w.encode()) % BUCKETS if at is None else at
        return [known[w] for w in words]


def _words(text: bytes | None) -> list[str]:
    """White space as ``str.split`` has it; bytes that are no UTF-8 read as U+FFFD."""
    return text.decode("utf-8", "replace").split() if text else []


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """``_words`` of all texts, one after the other, and how many each has."""
    try:
        texts = texts.cast(pa.string())
    except pa.ArrowInvalid:  # bytes that are no UTF-8
        texts = pa.array([None if t is None else t.decode("utf-8", "replace") for t in texts.to_pylist()], pa.string())
    lists = pc.utf8_split_whitespace(texts)
    words, n = lists.flatten(), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    blank = np.flatnonzero(pc.equal(pc.binary_length(words), 0).to_numpy(zero_copy_only=False))
    if len(blank):  # before and after a text's words
        n -= np.bincount(np.searchsorted(np.cumsum(n), blank, "right"), minlength=len(n))
        words = words.filter(pc.greater(pc.binary_length(words), 0))
    return words, n


def _lower(docs: DataFrame, text: str) -> DataFrame:
    return narrow(docs, text).select(F.lower(F.col(text)).cast("binary").alias("_text"))


def word_counts(docs: DataFrame, text: str = "text", held: int = 4_000_000) -> DataFrame:
    """``(w, n)`` of every word of all texts, as a written table.  A task gathers about
    ``held`` words before it counts them and hands the counts on, so a frequent word
    costs the shuffle a row per task."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered: list[pa.Array] = []

        def handed() -> pa.RecordBatch:
            counts = pa.chunked_array(gathered, pa.string()).value_counts()
            gathered.clear()
            return pa.RecordBatch.from_arrays([counts.field("values"), counts.field("counts")], names=["w", "n"])

        for b in batches:
            gathered.append(split(b.column(0))[0])
            if sum(map(len, gathered)) > held:
                yield handed()
        yield handed()

    parts = _lower(docs, text).mapInArrow(run, "w string, n long")
    return shared_table(parts.groupBy("w").agg(F.sum("n").alias("n")), "words")


def vocabulary(docs: DataFrame, text: str = "text", counts: DataFrame | None = None) -> Vocabulary:
    """Counted over all texts; ties in count go by the word."""
    counts = word_counts(docs, text) if counts is None else counts
    top = counts.orderBy(F.desc("n"), "w").limit(WORDS).collect()
    rest = counts.groupBy((F.crc32(F.col("w").cast("binary")) % BUCKETS).alias("b")).agg(F.sum("n").alias("n"))
    n = np.zeros(TOKENS)
    for r in rest.collect():  # BUCKETS rows
        n[WORDS + r["b"]] = r["n"]
    for i, r in enumerate(top):
        n[i] = r["n"]
        n[WORDS + zlib.crc32(r["w"].encode()) % BUCKETS] -= r["n"]
    return Vocabulary({r["w"]: i for i, r in enumerate(top)}, *classes(n), n[WORDS:])


def _share(n: float | np.ndarray, of: np.ndarray) -> np.ndarray:
    """Logarithm of a word's share of its bucket; one that was never counted has half a word."""
    return np.log(np.maximum(n, 0.5) / np.maximum(of, 0.5))


def kept_shares(counts: DataFrame, vocab: Vocabulary, kept: int = KEPT) -> tuple[dict[str, float], DataFrame]:
    """Log share within its bucket of each of up to ``kept`` words outside the
    vocabulary, by falling count, and the counts of all words with fewer.  Words of
    like count (an eighth of a doubling) are kept or left together."""
    level = F.floor(8 * F.log2("n"))
    least, total = None, 0
    for r in sorted(counts.groupBy(level.alias("l")).count().collect(), key=lambda r: -r["l"]):  # a few hundred rows
        total += r["count"]
        if total > kept + len(vocab.index):
            break
        least = r["l"]
    if least is None:
        return {}, counts
    own = {}
    for r in counts.where(level >= least).collect():  # at most ``kept`` and the vocabulary
        if r["w"] not in vocab.index:
            own[r["w"]] = float(_share(r["n"], vocab.rare[zlib.crc32(r["w"].encode()) % BUCKETS]))
    return own, counts.where(level < least)


def classes(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens in order of frequency, cut into classes of about equal counts;
    unseen tokens count as half a word."""
    n = np.maximum(counts, 0.5)
    order = np.argsort(-n, kind="stable")
    before = np.concatenate(([0], np.cumsum(n[order])[:-1])) / n.sum()
    of = np.empty(len(n), np.int64)
    of[order] = np.unique((before * CLASSES).astype(int), return_inverse=True)[1]
    return of, np.log(n / np.bincount(of, n)[of])


def initial(vocab: Vocabulary, seed: int = 7) -> np.ndarray:
    rng = np.random.default_rng(seed)
    p = np.zeros((PARAMETERS, SIZE), np.float32)
    p[:TOKENS] = rng.normal(0, 0.3, (TOKENS, SIZE))
    p[SCALES:OUTPUT] = 1 / WINDOW
    p[OUTPUT:BIAS] = rng.normal(0, 0.1, (2 * SIZE, SIZE))
    return p


def _output(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """SIZE x CLASSES weights and the CLASSES biases."""
    return p[OUTPUT:BIAS].reshape(SIZE, CLASSES), p[BIAS:].reshape(CLASSES)


def padded(texts: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All tokens in one array, texts apart by WINDOW paddings, and the places of
    the tokens in it."""
    lengths = np.array([len(t) for t in texts], np.int64)
    return spaced(np.concatenate([np.zeros(0, np.int64), *(np.array(t, np.int64) for t in texts)]), lengths)


def spaced(flat: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``padded``, of the texts' tokens one after the other and their numbers."""
    tokens = np.full(len(flat) + WINDOW * (len(lengths) + 1), TOKENS, np.int64)
    places = np.arange(len(flat)) + WINDOW * np.repeat(np.arange(1, len(lengths) + 1), lengths)
    tokens[places] = flat
    return tokens, places


def hidden(p: np.ndarray, run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For a run of tokens that begins and ends with WINDOW places more: the tokens'
    vectors and the units of the places between, a column per place, above a row of ones."""
    n = len(run) - 2 * WINDOW
    vectors = np.ascontiguousarray(p.take(run, axis=0).T)
    units = np.ones((SIZE + 1, n), np.float32)
    h = units[:SIZE]
    part = np.empty((GROUP, n), np.float32)
    for i in range(0, SIZE, GROUP):
        some, sums, scales = vectors[i : i + GROUP], h[i : i + GROUP], p[SCALES:OUTPUT, i : i + GROUP, None]
        np.multiply(some[:, :n], scales[0], out=sums)
        for k, d in enumerate(PLACES[1:], 1):
            sums += np.multiply(some[:, WINDOW + d : WINDOW + d + n], scales[k], out=part)
        np.tanh(sums, out=sums)
    return vectors, units


def class_scores(units: np.ndarray, u: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Of each place (a column) the classes' scores, less a constant: small enough for
    their exponentials.  Units lie between -1 and 1, which bounds the scores; only where
    the bounds are far apart is each place's own maximum taken."""
    reach = np.abs(u).sum(axis=0)
    near = (c + reach).max() - (c - reach).min() < 80
    z = np.concatenate([u, [c - (c + reach).max() if near else c]]).T @ units
    return z if near else z - z.max(axis=0)


def log_probabilities(p: np.ndarray, vocab: Vocabulary, tokens: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Of each token at ``places`` given those around it."""
    u, c = _output(p)
    out = np.empty(len(places))
    for lo in range(0, len(places), BATCH):
        at = places[lo : lo + BATCH]
        _, h = hidden(p, tokens[at[0] - WINDOW : at[-1] + WINDOW + 1])
        z = class_scores(h, u, c)
        own, place = tokens[at], at - at[0]
        out[lo : lo + BATCH] = z[vocab.classes[own], place] + vocab.inside[own]
        out[lo : lo + BATCH] -= np.log(np.exp(z, out=z).sum(axis=0))[place]
    return out


class Trainer:
    """Adagrad steps over one task's texts."""

    def __init__(self, p: np.ndarray, vocab: Vocabulary, rate: float = 0.1) -> None:
        self.p, self.vocab, self.rate = p.copy(), vocab, rate
        self.squares = np.full((PARAMETERS, 1), 1e-6, np.float32)
        self.used = np.zeros(PARAMETERS)

    def _step(self, rows: np.ndarray, grad: np.ndarray) -> None:
        squares = self.squares[rows] + np.square(grad).mean(axis=1, keepdims=True)
        self.squares[rows] = squares
        self.p[rows] -= self.rate * grad / np.sqrt(squares)

    def learn(self, tokens: np.ndarray, places: np.ndarray) -> None:
        p = self.p
        for lo in range(0, len(places), BATCH):
            at = places[lo : lo + BATCH]
            run, n = tokens[at[0] - WINDOW : at[-1] + WINDOW + 1], int(at[-1] - at[0]) + 1
            place, asked = at - at[0], np.zeros(n, np.int32)
            asked[place] = 1
            vectors, units = hidden(p, run)
            h = units[:SIZE]
            u, c = _output(p)
            g = class_scores(units, u, c)
            np.exp(g, out=g)
            g *= (asked / g.sum(axis=0)).astype(np.float32)  # nothing where nothing is asked
            g.reshape(-1)[self.vocab.classes[tokens[at]] * n + place] -= 1
            # Back from the places to the tokens around them: one column per token of the run.
            out = units @ g.T  # the last row is the biases'
            d = u @ g
            times = np.zeros(len(run), np.int32)
            for off in PLACES:
                times[WINDOW + off : WINDOW + off + n] += asked
            used = np.bincount(run, times, TOKENS + 1)
            rows = np.flatnonzero(used[:TOKENS])  # padding stays zero
            rank = np.full(TOKENS + 1, len(rows))
            rank[rows] = np.arange(len(rows))
            rank = rank[run]
            grad, scales = np.empty((SIZE, len(rows)), np.float32), np.empty((len(PLACES), SIZE), np.float32)
            wide, part = np.empty((GROUP, len(run)), np.float32), np.empty((GROUP, n), np.float32)
            for i in range(0, SIZE, GROUP):
                group = slice(i, i + GROUP)
                back, unit = d[group], h[group]
                np.multiply(unit, unit, out=unit)
                back *= np.subtract(1, unit, out=unit)
                wide[:] = 0
                for k, off in enumerate(PLACES):
                    there = slice(WINDOW + off, WINDOW + off + n)
                    scales[k, group] = np.einsum("ij,ij->i", back, vectors[group, there])
                    wide[:, there] += np.multiply(back, p[SCALES + k, group, None], out=part)
                for own, parts in zip(grad[group], wide):
                    own[:] = np.bincount(rank, parts, len(rows) + 1)[:-1] / len(at)
            self._step(rows, np.ascontiguousarray(grad.T))
            self.used[: TOKENS + 1] += used
            rest = np.concatenate([scales, out.reshape(-1, SIZE)]) / len(at)
            self._step(np.arange(SCALES, PARAMETERS), rest.astype(np.float32))
            self.used[SCALES:] += len(at)


def gathered(batches: Iterator[pa.RecordBatch], held: int = GATHERED) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in larger ones, of up to ``held`` bytes; a batch beyond stays alone."""
    some: list[pa.RecordBatch] = []
    for b in batches:
        if some and sum(x.nbytes for x in some) + b.nbytes > held:
            yield pa.concat_batches(some)
            some = []
        some.append(b)
    if some:
        yield pa.concat_batches(some)


def token_table(
    docs: DataFrame, vocab: Vocabulary, id: str = "doc_id", text: str = "text", counts: DataFrame | None = None, kept: int = KEPT
) -> tuple[DataFrame, DataFrame | None]:
    """``(id, n_tokens, _ids, _more, _left, _row)`` per row: the tokens of a text, what its
    words add beyond their tokens, the words whose counts must be joined from the second
    table (see ``score``), and the row's number, fixed once the table is written.  Words
    are split and looked up here, once."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = narrow(docs, id, text).select(id, F.lower(F.col(text)).cast("binary").alias("_text"))
    schema = rows.drop("_text").schema.add("n_tokens", "long").add("_ids", ArrayType(ShortType())).add("_more", "double")
    schema = schema.add("_left", ArrayType(StringType()))
    own, others = ({}, None) if counts is None else kept_shares(counts, vocab, kept)
    by_word = counts is not None
    shared = spark.sparkContext.broadcast((vocab, own))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, shares = shared.value
        held = pa.array([*words.index, *shares], pa.string())
        token_of = np.array([*words.index.values(), *words.ids(list(shares), {}), 0], np.int16)
        share_of = np.array([*[0.0] * len(words.index), *shares.values(), 0.0])  # the last: of no held word
        for b in gathered(batches):
            flat, n = split(b.column("_text"))
            ends = np.cumsum(n)
            found = pc.fill_null(pc.index_in(flat, held), len(held)).to_numpy(zero_copy_only=False)
            tokens, extra = token_of[found], share_of[found]
            other = np.flatnonzero(found == len(held))
            coded = flat.take(pa.array(other)).dictionary_encode()  # each word is hashed once
            hashed = np.array(words.ids(coded.dictionary.to_pylist(), {}), np.int16)
            tokens[other] = hashed[coded.indices.to_numpy(zero_copy_only=False)]
            joined = other if by_word else other[:0]
            until = np.searchsorted(joined, np.concatenate(([0], ends)))  # of each text's words that are joined
            left = pa.ListArray.from_arrays(pa.array(until, pa.int32()), flat.take(pa.array(joined)))
            total = np.concatenate(([0], np.cumsum(extra)))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), pa.array(tokens, pa.int16()))
            columns = [b.column(id), pa.array(n), lists, pa.array(total[ends] - total[ends - n]), left]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema).withColumn("_row", F.monotonically_increasing_id()), others


def _numbers(ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of all texts, one after the other, and how many each has."""
    return ids.flatten().to_numpy(zero_copy_only=False).astype(np.int64), ids.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)


def fit(
    docs: DataFrame, vocab: Vocabulary, text: str = "text", rounds: int = ROUNDS, stride: int = 1, tokens: DataFrame | None = None
) -> np.ndarray:
    """Parameters after ``rounds`` of training and averaging over all texts.  Rows
    that no task changed keep their values; texts without words teach nothing.  With
    a ``stride`` above 1 a round reads only each ``stride``-th place.  ``tokens``: the
    texts' written ``token_table``, so that no round splits them again."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = _lower(docs, text) if tokens is None else tokens.select("_ids")
    names = [f"v{i}" for i in range(SIZE)]
    schema = ", ".join(["row int", "n double", *(f"{c} float" for c in names)])
    p, whole = initial(vocab), tokens is None
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast((p, vocab))  # of fixed size

        def run(batches: Iterator[pa.RecordBatch], shared=shared, turn=turn) -> Iterator[pa.RecordBatch]:
            start, own = shared.value
            trainer, known = Trainer(start, own), {}
            for b in batches:
                if whole:
                    run_, places = padded([own.ids(_words(t), known) for t in b.column(0).to_pylist()])
                    if len(known) > 300_000:
                        known.clear()
                else:
                    run_, places = spaced(*_numbers(b.column(0)))
                trainer.learn(run_, places[turn % stride :: stride])
            at = np.flatnonzero(trainer.used[:PARAMETERS])
            columns = [pa.array(at, pa.int32()), pa.array(trainer.used[at])]
            yield pa.RecordBatch.from_arrays(
                [*columns, *(pa.array(trainer.p[at, i], pa.float32()) for i in range(SIZE))], names=["row", "n", *names]
            )

        sums = [(F.sum(F.col(c) * F.col("n")) / F.sum("n")).alias(c) for c in names]
        mean = shared_table(rows.mapInArrow(run, schema).groupBy("row").agg(*sums), "parameters")
        for r in mean.collect():  # PARAMETERS rows
            p[r["row"]] = r[1:]
    return p


def score(
    docs: DataFrame,
    p: np.ndarray,
    vocab: Vocabulary,
    id: str = "doc_id",
    text: str = "text",
    counts: DataFrame | None = None,
    kept: int = KEPT,
    tokens: tuple[DataFrame, DataFrame | None] | None = None,
) -> DataFrame:
    """``(id, n_tokens, log_likelihood, mean_log_probability)`` per row of ``docs``.

    A null, empty or blank text has no tokens, log-likelihood 0 and a null mean.
    Whole texts are scored, whatever their length, in bounded steps; repeated rows
    score alike, and an empty table gives no rows.

    With ``counts`` (of ``word_counts``) a word outside the vocabulary adds the log
    share of its own count in its bucket, a word without a count that of half a word.
    Tasks hold the shares of up to ``kept`` words; words beyond are joined to the
    table.  Without ``counts`` such words are scored as their bucket.  ``tokens``: what
    ``token_table`` gave for the same arguments, the first of the two written.
    """
    spark = docs.sparkSession
    rows, others = token_table(docs, vocab, id, text, counts, kept) if tokens is None else tokens
    if others is not None and tokens is None:
        rows = shared_table(rows, "tokens")
    texts = rows.select(id, "n_tokens", "_row", "_ids", "_more")  # the words to join stay in the table
    schema = StructType([*texts.schema.fields[:3], StructField("_log", DoubleType())])
    shared = spark.sparkContext.broadcast((p, vocab))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, words = shared.value
        for b in batches:
            flat, n = _numbers(b.column("_ids"))
            each = np.concatenate(([0], np.cumsum(log_probabilities(p, words, *spaced(flat, n)))))
            ends = np.cumsum(n)
            total = each[ends] - each[ends - n] + b.column("_more").to_numpy(zero_copy_only=False)
            kept_ = [b.column(f) for f in schema.names[:-1]]
            yield pa.RecordBatch.from_arrays([*kept_, pa.array(total)], names=schema.names)

    out = texts.mapInArrow(run, schema)
    total = F.col("_log")
    if others is not None:
        out = shared_table(out, "scored")
        of = F.greatest(F.element_at(F.array(*map(F.lit, vocab.rare.tolist())), (F.crc32(F.col("w").cast("binary")) % BUCKETS + 1).cast("int")), F.lit(0.5))
        each = rows.select("_row", F.explode("_left").alias("w")).join(others, "w", "left")
        each = each.select("_row", F.log(F.coalesce(F.col("n").cast("double"), F.lit(0.5)) / of).alias("_share"))
        out = out.join(each.groupBy("_row").agg(F.sum("_share").alias("_joined")), "_row", "left")
        total = total + F.coalesce("_joined", F.lit(0.0))
    mean = F.when(F.col("n_tokens") > 0, total / F.col("n_tokens"))
    return out.select(id, "n_tokens", total.alias("log_likelihood"), mean.alias("mean_log_probability"))


def pseudo_likelihood(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Vocabulary, network and scores of all documents."""
    counts = word_counts(docs, text)
    vocab = vocabulary(docs, text, counts)
    rows, others = token_table(docs, vocab, id, text, counts)
    rows = shared_table(rows, "tokens")
    return score(docs, fit(docs, vocab, text, tokens=rows), vocab, id, text, counts, tokens=(rows, others))
