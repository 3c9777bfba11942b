"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A word is the bag of itself and its character n-grams (with marks for its ends),
hashed into a fixed number of rows of an embedding table; its vector is their scaled
sum.  A segment of ``SEGMENT`` consecutive words is the weighted mean of their
vectors (frequent words weigh less), and a linear softmax over it gives the
probability that the segment is toxic.  A passage of up to ``PASSAGE`` consecutive
segments is toxic if any of them is, ``1 - product(1 - p)``, and a text is as toxic as
its most toxic passage.  Averaged over a whole long text, a few words would drown;
joined over all segments, the small chances of clean ones would add up with length.

Table and softmax are trained jointly, in numpy, from the texts' labels.  A misspelt
or inflected word that training never saw still shares n-grams with words it did see.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import narrow, shared_table, small_batches

# Training takes at most so many labelled rows of each class, in the order of a
# hash of their ids, and as many of them as fit half of so many bytes of text.
TRAIN_ROWS, TRAIN_BYTES = 2000, 32 << 20
ROWS, SIZE, NGRAMS = 1 << 17, 8, range(3, 6)
SEGMENT = 4
PASSAGE = 100  # segments
TURN = 0.02  # step of the softmax's weights beside that of the rows
SPREAD = 0.05  # of the rows' first components
START = -8.0  # log-odds of a segment before training
SCALE = 10.0  # of a word's sum: about as many of its n-grams say something
RARE = 1e-3  # a word's weight is RARE / (RARE + its share of the training words)

# Outer punctuation of a word, which its n-grams leave out.
_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»“”„‘’…¿¡–—"


def subwords(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of each word and of its n-grams, one word after the other, and the number
    of rows of each word (0 for punctuation alone).  N-grams are hashed by a
    polynomial of their code points."""
    bare = [w.lower().strip(_PUNCTUATION) for w in words]
    joined = "".join([f"<{w}>" for w in bare if w])
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.array([len(w) + 2 if w else 0 for w in bare], np.int64)
    ends = np.cumsum(lengths)
    if not len(codes):
        return np.zeros(0, np.int64), lengths
    last = np.repeat(ends, lengths) - np.arange(len(codes))  # letters from here to the word's end
    rows = np.zeros((len(codes), 1 + len(NGRAMS)), np.int64)
    valid = np.zeros(rows.shape, bool)
    begins = (ends - lengths)[lengths > 0]
    rows[begins, 0] = [zlib.crc32(w.encode("utf-8", "surrogatepass")) % ROWS for w in bare if w]
    valid[begins, 0] = True
    for c, n in enumerate(NGRAMS, 1):
        h = np.full(len(codes), n, np.uint64)
        for k in range(n):
            m = max(0, len(codes) - k)
            h[:m] = (h[:m] ^ codes[k:]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        rows[:, c] = (h >> np.uint64(20)) % np.uint64(ROWS)
        valid[:, c] = last >= n
    return rows[valid], _sums(valid.sum(axis=1), lengths).astype(np.int64)


def _sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of rows; a run may be empty."""
    total = np.concatenate((np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)))
    ends = np.cumsum(lengths)
    return total[ends] - total[ends - lengths]


def _passages(values: np.ndarray) -> np.ndarray:
    """Sums of each run of PASSAGE consecutive values, or of all if there are fewer."""
    if len(values) <= PASSAGE:
        return values.sum(keepdims=True)
    total = np.concatenate(([0.0], np.cumsum(values)))
    return total[PASSAGE:] - total[:-PASSAGE]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Model:
    table: np.ndarray  # ROWS x SIZE
    weights: np.ndarray  # SIZE x 2
    bias: np.ndarray  # 2
    common: dict[str, float] = field(default_factory=dict)  # weights of frequent words

    def __post_init__(self) -> None:
        self.row = (self.table @ (self.weights[:, 1] - self.weights[:, 0])).astype(np.float64) / SCALE
        self.offset = float(self.bias[1] - self.bias[0])

    def words(self, words: Sequence[str]) -> np.ndarray:
        """Each word's part in the odds of a segment, and its weight in the mean."""
        rows, lengths = subwords(words)
        weight = np.array([self.common.get(w, 1.0) for w in words])
        return np.stack([_sums(self.row[rows], lengths) * weight, weight], axis=1)


class Scorer:
    """Scores texts.  The model is linear in the words, so each different word is
    looked up once, up to ``kept`` of them; then all are forgotten."""

    def __init__(self, model: Model, kept: int = 300_000) -> None:
        self.model, self.kept = model, kept
        self.known: dict[str, int] = {}
        self.values = np.zeros((0, 2))

    def scores(self, texts: Sequence[str | None]) -> np.ndarray:
        """Probability of each text to be toxic."""
        split = [(t or "").split() for t in texts]
        if len(self.known) > self.kept:
            self.known, self.values = {}, np.zeros((0, 2))
        if new := list({w for words in split for w in words}.difference(self.known)):
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
            self.values = np.concatenate((self.values, self.model.words(new)))
        n = np.array([len(words) for words in split], np.int64)
        out = np.full(len(n), _sigmoid(self.model.offset))
        if not n.sum():
            return out
        both = self.values[[self.known[w] for words in split for w in words]]
        segments = -(-n // SEGMENT)
        number = np.arange(segments.sum()) - np.repeat(np.cumsum(segments) - segments, segments)
        starts = np.repeat(np.cumsum(n) - n, segments) + number * SEGMENT
        sums = np.add.reduceat(both, starts, axis=0)
        odds = np.clip(sums[:, 0] / sums[:, 1] + self.model.offset, -30, 30)
        full = segments > 0
        unlike = np.logaddexp(0, odds)
        begins = np.cumsum(segments) - segments
        clean = np.add.reduceat(unlike, begins[full])
        out[full] = -np.expm1(-clean)
        for k in np.flatnonzero(segments > PASSAGE):
            out[k] = -np.expm1(-_passages(unlike[begins[k] : begins[k] + segments[k]]).max())
        return out


def train(
    texts: Iterable[tuple[str | None, int]],
    epochs: int = 8,
    batch: int = 16,
    rate: float = 1.0,
    toxic_weight: float = 6.0,
    min_texts: int = 5,
    seed: int = 1,
) -> Model:
    """Fit on (text, label) pairs by mini-batches with adaptive steps (Adagrad).

    Rows begin as small random vectors, the classes' weights as random ones, and both
    are free to go anywhere.  Rows that fewer than ``min_texts`` texts use stay zero, as
    does all that training never saw: such n-grams say nothing.  Texts without words are left out.  Without
    texts of both classes nothing can be told apart, and all scores are about 0.
    """
    words: dict[str, int] = {}
    docs, labels = [], []
    for text, label in texts:
        if own := (text or "").split():
            docs.append(np.array([words.setdefault(w, len(words)) for w in own], np.int32))
            labels.append(label)
    rng = np.random.default_rng(seed)
    y = np.array(labels, np.float64)
    # Softmax over (clean, toxic), each class with weights of its own.
    weights, table = rng.normal(0, SIZE**-0.5, (SIZE, 2)).astype(np.float32), np.zeros((ROWS, SIZE), np.float32)
    if not 0 < y.sum() < len(y):
        return Model(table, weights, np.array([15, -15], np.float32))
    odds = START  # few segments are toxic, even of toxic texts
    frequency = np.bincount(np.concatenate(docs), minlength=len(words))
    weight = RARE / (RARE + frequency / frequency.sum())
    flat, lengths_of = subwords(list(words))
    starts = np.concatenate(([0], np.cumsum(lengths_of)))
    seen = np.zeros(ROWS, np.int32)
    for d in docs:
        seen[np.unique(np.concatenate([flat[starts[w] : starts[w + 1]] for w in np.unique(d)]))] += 1
    learnt = seen >= min_texts
    table[learnt] = rng.normal(0, SPREAD, (int(learnt.sum()), SIZE))
    squares, turned = np.where(learnt, 1e-9, np.inf).astype(np.float32)[:, None], np.full_like(weights, 1e-9)
    for epoch in range(epochs):
        order = rng.permutation(len(docs))
        for lo in range(0, len(order), batch):
            rows = order[lo : lo + batch]
            step = rate * (1 - (epoch + lo / len(order)) / epochs)
            index = np.concatenate([docs[r] for r in rows])
            segments = np.array([-(-len(docs[r]) // SEGMENT) for r in rows])
            sizes = np.concatenate([np.diff([*range(0, len(docs[r]), SEGMENT), len(docs[r])]) for r in rows])
            # Forward: vectors of the different words, then segments, then texts.
            used, back = np.unique(index, return_inverse=True)
            n = lengths_of[used]
            ends = np.cumsum(n)
            entry = flat[np.repeat(starts[used] - (ends - n), n) + np.arange(ends[-1])]
            vectors = _sums(table[entry], n) / SCALE
            part = weight[index] / np.repeat(_sums(weight[index], sizes), sizes)
            direction = weights[:, 1] - weights[:, 0]
            z = _sums((vectors @ direction)[back] * part, sizes) + odds
            p = _sigmoid(z)
            unlike, begins = -np.log1p(-p), np.cumsum(segments) - segments
            joint, best = _sums(unlike, segments), np.ones(len(p), bool)
            for k in np.flatnonzero(segments > PASSAGE):
                of = _passages(unlike[begins[k] : begins[k] + segments[k]])
                joint[k] = of.max()
                best[begins[k] : begins[k] + segments[k]] = False
                best[begins[k] + of.argmax() :][:PASSAGE] = True
            any_ = np.clip(-np.expm1(-joint), 1e-6, 1)
            # Backward, for the negative log-likelihood of the texts' labels: a clean
            # text is clean in every segment, a toxic one is so by its best passage.
            toxic, whole = np.repeat(y[rows], segments), np.repeat(any_, segments)
            d_z = np.where(toxic == 1, -toxic_weight * (1 - whole) / whole * p * best, p) / len(rows)
            d_word = np.bincount(back, np.repeat(d_z, sizes) * part, len(used))
            d_weights = (vectors.T @ d_word).astype(np.float32)
            d_row = np.bincount(entry, np.repeat(d_word / SCALE, n), ROWS).astype(np.float32)
            at = np.flatnonzero(d_row)
            grad = d_row[at, None] * direction.astype(np.float32)
            squares[at] += (grad**2).mean(axis=1, keepdims=True)
            table[at] -= step * grad / np.sqrt(squares[at])
            both = np.stack([-d_weights, d_weights], axis=1)
            turned += both**2
            weights -= TURN * step * both / np.sqrt(turned)
            odds -= 0.1 * float(d_z.sum())
    common = {w: float(weight[i]) for w, i in words.items() if weight[i] < 0.98}
    return Model(table, weights, np.array([-odds / 2, odds / 2], np.float32), common)


def held_out(id: Column) -> Column:
    """Rows that are never learnt from: crc32 of the id as text divides by 5."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_texts(
    docs: DataFrame, labels: DataFrame, id: str, text: str, label: str, rows: int = TRAIN_ROWS, most: int = TRAIN_BYTES
) -> Iterator[tuple[str | None, int]]:
    """(text, label) of the bounded sample: per class the first ``rows`` labelled
    ids by hash that aren't held out, up to half of ``most`` bytes for each class.  A
    text that doesn't fit what is left is skipped, and the next ones are tried.  Null
    labels or ids teach nothing; an id with several labels or texts gives a row for
    each.  Raises ValueError if a class has labelled texts and none of them fits."""
    marks = narrow(labels, id, label).where(F.col(label).isin(0, 1) & F.col(id).isNotNull() & ~held_out(F.col(id)))
    marks = marks.select(F.col(id).alias("_id"), F.col(label).cast("int").alias("_y"), F.xxhash64(id).alias("_order"))
    chosen = [marks.where(F.col("_y") == y).orderBy("_order", "_id").limit(rows) for y in (0, 1)]
    sample = shared_table(chosen[0].unionByName(chosen[1]), "labelled")  # at most 2 x rows
    texts = narrow(docs, id, text).join(F.broadcast(sample), F.col(id) == F.col("_id"))
    texts = texts.select("_order", F.col(text).alias("_text"), "_y", F.monotonically_increasing_id().alias("_row"))
    texts = shared_table(texts, "training")
    # By their sizes first, so that the driver never holds a text that is left out.
    order = ["_order", F.xxhash64("_text"), "_y", "_row"]
    sizes = texts.withColumn("_size", F.coalesce(F.octet_length("_text"), F.lit(0))).orderBy(*order).select("_row", "_y", "_size")
    room, taken, seen = {0: most // 2, 1: most // 2}, [], {0: 0, 1: 0}
    for r in sizes.toLocalIterator():
        seen[r["_y"]] += 1
        if r["_size"] <= room[r["_y"]]:
            room[r["_y"]] -= r["_size"]
            taken.append((r["_row"], r["_y"]))
    for y, n in seen.items():
        if n and not any(own == y for _, own in taken):
            raise ValueError(f"none of the {n} labelled texts of class {y} fits {most // 2} bytes")
    if not taken:
        return
    fits = docs.sparkSession.createDataFrame([(r,) for r, _ in taken], "_row long")
    for r in texts.join(F.broadcast(fits), "_row").orderBy(*order).toLocalIterator():
        yield r["_text"], r["_y"]


def score(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text", kept: int = 300_000) -> DataFrame:
    """``docs`` with ``_score`` (0 to 1, higher: toxic likelier), all rows and
    columns.  Words are split at white space; a null, empty or blank text gets one
    empty segment's score.  Whole texts are read; repeated rows score alike.  Bytes that
    are no UTF-8 read as U+FFFD.

    A task keeps what it knows of up to ``kept`` different words.
    """
    small_batches(docs.sparkSession)
    names = docs.columns
    rows = docs.toDF(*(f"_c{i}" for i in range(len(names))))
    rows = rows.withColumn("_text", F.col(f"_c{names.index(text)}").cast("binary"))
    schema = rows.drop("_text").schema.add("_score", "double")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # ROWS x SIZE numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value, kept)
        for b in batches:
            scores = scorer.scores([t.decode("utf-8", "replace") if t else None for t in b.column("_text").to_pylist()])
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(scores)], names=schema.names)

    return rows.mapInArrow(run, schema).toDF(*names, "_score")


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """The model trained on the bounded sample, the same for the same rows."""
    return train(training_texts(docs, labels, id, text, label))


def drop_toxic(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, that score below ``threshold``."""
    names = docs.columns
    scored = score(docs, fit(docs, labels, id, text), id, text).toDF(*(f"_c{i}" for i in range(len(names))), "_score")
    return scored.where(F.col("_score") < threshold).drop("_score").toDF(*names)
