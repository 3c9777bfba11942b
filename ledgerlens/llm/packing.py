"""Best-fit packing of token pieces after Martello-Toth dominance reduction.

Packing needs only the lengths, and lengths are whole numbers from 1 to the
capacity.  So the instance is a histogram of at most ``capacity`` counts, however
many documents there are.  The driver reduces and packs that histogram: equal
sequences are one pattern with a number of copies.  Spark numbers the pieces within
each length and looks their slots up in the pattern table, whose size the capacity
bounds as well.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import narrow, shared_table, small_batches

Pattern = tuple[tuple[int, ...], int]  # lengths in one sequence, number of such sequences


# -- tokens ----------------------------------------------------------------------


# The byte-level pre-tokenizer's pattern (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[str, int]:
    """Letters that byte-level vocabularies write bytes with: printable Latin-1
    stands for itself, the other bytes get letters from U+0100 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(rest)}


class Encoder:
    """Token ids of whole texts, as the tokenizer file gives them without adding
    special tokens; where a text itself holds one of the file's added tokens, that is
    the token's id.

    A byte-level vocabulary whose ids are its merge order is also loaded as ranks:
    ``tiktoken`` encodes those some four times faster, to the same ids.  Texts with
    letters beyond U+052F (whose classes differ between Unicode versions) or with very
    long runs, or with an added token, go through ``tokenizers``, as do all texts for other
    files."""

    _odd = re.compile(r"[^\x00-\u052f]")
    _long = 1000

    def _plain(self, text: str) -> bool:
        if any(t in text for t in self.added):
            return False
        lengths = [len(w) for w in text.split()]
        if lengths and max(lengths) >= self._long or len(text) - sum(lengths) - len(lengths) >= self._long:
            return False
        try:
            text.encode("latin-1")
            return True
        except UnicodeEncodeError:
            return not self._odd.search(text)

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.ranks = None
        spec = json.loads(self.tokenizer.to_str())
        first, model = spec["pre_tokenizer"] or {}, spec["model"]
        byte_level = first.get("type") == "ByteLevel" and first.get("use_regex") and not first.get("add_prefix_space")
        if byte_level and model["type"] == "BPE" and not spec["normalizer"] and not model["dropout"]:
            self.added = special = {t["content"] for t in spec["added_tokens"]}
            letters = _byte_letters()
            ranks = {bytes(letters[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
            merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
            in_order = [model["vocab"][t] for t in merged]
            if in_order == sorted(set(in_order)):
                import tiktoken

                self.ranks = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if self.ranks and self._plain(text):
            return self.ranks.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def token_pieces(
    docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text", capacity: int = 1024, end_id: int = 2
) -> DataFrame:
    """``(id, piece, start, length, ids_crc32)``: a document's ids, then
    ``end_id``, cut into pieces of ``capacity`` if there are more; the first piece
    takes the rest.  A null or empty text is the end id alone.  Rows are taken as
    they come: a repeated id is another document.  Bytes that are no UTF-8 read as
    U+FFFD."""
    small_batches(docs.sparkSession)
    rows = narrow(docs, id, text).select(F.col(id), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_text"))
    schema = rows.drop("_text").schema
    for name, kind in (("piece", "integer"), ("start", "long"), ("length", "long"), ("ids_crc32", "long")):
        schema = schema.add(name, kind)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        for b in batches:
            at, piece, start, length, crc = [], [], [], [], []
            for row, t in enumerate(b.column("_text").to_pylist()):
                ids = memoryview(own.encode(t.decode("utf-8", "replace")) + end)
                n = len(ids) // 4
                cuts = [0, *range(n % capacity or min(n, capacity), n + 1, capacity)]
                for k, (lo, hi) in enumerate(pairwise(cuts)):
                    at.append(row)
                    piece.append(k)
                    start.append(lo)
                    length.append(hi - lo)
                    crc.append(zlib.crc32(ids[4 * lo : 4 * hi]))
            columns = [b.column(id).take(pa.array(at, pa.int32())), pa.array(piece, pa.int32())]
            columns += [pa.array(x, pa.int64()) for x in (start, length, crc)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema)


# -- the histogram -----------------------------------------------------------------


def _largest(sizes: list[int], most: int) -> int | None:
    i = bisect_right(sizes, most)
    return sizes[i - 1] if i else None


def _smallest_sum(count: Counter, sizes: list[int], without: int, n: int, above: int = 0) -> int | None:
    """Sum of the ``n`` smallest items over ``above``, one item of size
    ``without`` left out; None if there are fewer."""
    total = 0
    for s in sizes:
        if s <= above:
            continue
        take = min(n, count[s] - (s == without))
        total, n = total + take * s, n - take
        if not n:
            return total
    return None


def reduce_instance(counts: dict[int, int], capacity: int) -> tuple[list[Pattern], dict[int, int]]:
    """Martello-Toth reduction: sequences that some optimal packing holds, and
    what is left of the histogram.

    For an item ``j``, a feasible set with ``j`` dominates all others if each of them maps
    onto it, part by part, by items at most as long.  Sets of up to three items are
    tried, longest item first: ``j`` alone if nothing fits beside it; ``j`` with the
    longest item that fits beside it, if they fill the sequence, if no two others fit
    beside ``j``, or if that item is as long as the best two that do; ``j`` with the
    best two, if the longer of them is the longest that fits at all and no fitting
    pair has both items longer than the shorter one.  A set is fixed as often as its items last: taking
    items away only removes alternatives.
    """
    count = Counter({k: n for k, n in counts.items() if n > 0})
    fixed: Counter = Counter()

    def fix(*sizes: int) -> None:
        need = Counter(sizes)
        times = min(count[s] // k for s, k in need.items())
        fixed[tuple(sorted(sizes, reverse=True))] += times
        for s, k in need.items():
            count[s] -= k * times
            if not count[s]:
                del count[s]

    changed = True
    while changed:
        changed = False
        for j in sorted(count, reverse=True):
            while count.get(j):
                room = capacity - j
                sizes = sorted(s for s in count if s != j or count[s] > 1)
                beside = _largest(sizes, room)
                if beside is None:
                    fix(j)
                elif beside == room:
                    fix(j, beside)
                else:
                    two = _smallest_sum(count, sizes, j, 2)
                    if two is None or two > room:
                        fix(j, beside)
                        changed = True
                        continue
                    three = _smallest_sum(count, sizes, j, 3)
                    if three is not None and three <= room:
                        break  # sets of four may fit: no verdict
                    best = max(
                        ((a + b, a, b) for a in sizes if (b := _partner(count, sizes, j, a, room)) is not None), default=None
                    )
                    if best is None or beside >= best[0]:
                        fix(j, beside)
                    else:
                        _, a, b = best
                        longer = _smallest_sum(count, sizes, j, 2, above=b)
                        if a != beside or (longer is not None and longer <= room):
                            break
                        fix(j, a, b)
                changed = True
    return sorted(fixed.items(), reverse=True), dict(count)


def _partner(count: Counter, sizes: list[int], j: int, a: int, room: int) -> int | None:
    """The longest item, at most as long as ``a``, that fits with ``a`` beside ``j``."""
    b = _largest(sizes, min(a, room - a))
    while b is not None and count[b] < 1 + (b == a) + (b == j):
        b = _largest(sizes, b - 1)
    return b


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-fit decreasing over a histogram: each item goes to the fullest open
    sequence that takes it.  Sequences of equal content are handled together, so the
    work depends on the lengths, not on the number of items."""
    open_: dict[int, Counter] = {}  # room left: contents: number of sequences
    for size in sorted(counts, reverse=True):
        left = counts[size]
        for room in sorted(r for r in open_ if r >= size):
            if not left:
                break
            fit = room // size
            for content in sorted(open_[room]):
                have = open_[room][content]
                full, part = divmod(left, fit)
                full, part = (have, 0) if full >= have else (full, part)
                for times, k in ((full, fit), (1 if part else 0, part)):
                    if times:
                        open_.setdefault(room - k * size, Counter())[content + (size,) * k] += times
                        open_[room][content] -= times
                        left -= times * k
                if not open_[room][content]:
                    del open_[room][content]
                if not left:
                    break
        fit = capacity // size
        full, part = divmod(left, fit)
        for times, k in ((full, fit), (1 if part else 0, part)):
            if times:
                open_.setdefault(capacity - k * size, Counter())[(size,) * k] += times
    total: Counter = Counter()
    for contents in open_.values():
        total.update(contents)
    return sorted(total.items(), reverse=True)


def plan(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Patterns that pack the histogram: dominating sets, then best fit."""
    fixed, rest = reduce_instance(counts, capacity)
    return [*fixed, *best_fit(rest, capacity)]


def slots(patterns: list[Pattern]) -> np.ndarray:
    """Rows (length, first rank, first sequence, items per sequence, offset of the
    first), ordered by length and rank: the piece of rank ``r`` is item
    ``(r - first rank) % items`` of sequence ``first sequence + (r - first rank) // items``."""
    rank: Counter = Counter()
    rows, base = [], 0
    for content, times in patterns:
        offset = 0
        for size in sorted(set(content), reverse=True):
            k = content.count(size)
            rows.append((size, rank[size], base, k, offset))
            rank[size] += k * times
            offset += k * size
        base += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, capacity: int = 1024, length: str = "length") -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: as few sequences of at most
    ``capacity`` as the method finds.  Lengths must be 1 to ``capacity`` (others
    raise).  Any columns pass through; an empty table gives no rows.

    Pieces are numbered within their length by partition of a written table: a length
    that a third of all pieces have is spread over as many tasks as that table has
    partitions.
    """
    spark = pieces.sparkSession
    names = pieces.columns
    inner = [f"_c{i}" for i in range(len(names))]
    size = F.col(inner[names.index(length)])
    rows = shared_table(pieces.toDF(*inner).withColumn("_row", F.monotonically_increasing_id()), "pieces")
    rows = rows.withColumns({"_part": F.shiftright("_row", 33).cast("int"), "_size": size.cast("long")})
    per_part = shared_table(rows.groupBy("_size", "_part").agg(F.count(F.lit(1)).alias("n")), "lengths")
    histogram = per_part.groupBy("_size").agg(F.sum("n").alias("n"))
    if not histogram.where(f"_size is null or _size < 1 or _size > {capacity}").isEmpty():
        raise ValueError(f"lengths must be 1 to {capacity}")
    counts = {r["_size"]: r["n"] for r in histogram.collect()}  # at most `capacity` rows
    table = spark.sparkContext.broadcast(slots(plan(counts, capacity)))
    before = Window.partitionBy("_size").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_part.select("_size", "_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    starts = shared_table(starts, "starts")
    within = Window.partitionBy("_size", "_part").orderBy("_row")
    ranked = rows.withColumn("_rank", F.row_number().over(within) - 1).join(starts, ["_size", "_part"])
    ranked = ranked.select(*inner, "_size", (F.col("_rank") + F.col("_before")).alias("_rank"))
    schema = ranked.select(*inner).schema.add("sequence_id", "long").add("offset", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes, firsts, bases, items, offsets = table.value.T
        groups = {int(s): slice(*np.searchsorted(sizes, [s, s + 1])) for s in np.unique(sizes)}
        for b in batches:
            want, rank = (b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("_size", "_rank"))
            row = np.empty(len(want), np.int64)
            for s in np.unique(want):
                at, own = want == s, groups[int(s)]
                row[at] = own.start + np.searchsorted(firsts[own], rank[at], "right") - 1
            item = rank - firsts[row]
            added = [pa.array(bases[row] + item // items[row]), pa.array(offsets[row] + item % items[row] * want)]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(inner)], *added], names=schema.names)

    return ranked.mapInArrow(run, schema).toDF(*names, "sequence_id", "offset")


def pack_documents(
    docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text", capacity: int = 1024, end_id: int = 2
) -> DataFrame:
    """``(id, piece, start, length, ids_crc32, sequence_id, offset)`` of all documents."""
    return pack(token_pieces(docs, tokenizer, id, text, capacity, end_id), capacity)
