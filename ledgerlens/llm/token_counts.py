"""Word-piece counts by a linear longest-match automaton.

The vocabulary's trie gets, for each node, a failure link and the number of pieces
popped when it is followed: if no edge continues a node's string ``s``, greedy
longest match would emit pieces ``p1 .. pk`` and go on with a rest of ``s`` that is
itself a node.  Counts are computed once, breadth first; a word then takes one step
per character and at most as many links, and no piece is ever built.

Pieces that start a word and pieces that continue one have a root each.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import narrow, small_batches

NONE = -1  # no failure link: the word can't be split into pieces


class Automaton:
    """``first``: pieces that may start a word; ``rest``: pieces that may follow."""

    def __init__(self, first: Iterable[str], rest: Iterable[str]) -> None:
        # Node 0 starts words, node 1 continues them.
        self.edges: list[dict[str, int]] = [{}, {}]
        piece = [False, False]
        for root, pieces in ((0, first), (1, rest)):
            for p in pieces:
                at = root
                for c in p:
                    if c not in self.edges[at]:
                        self.edges[at][c] = len(self.edges)
                        self.edges.append({})
                        piece.append(False)
                    at = self.edges[at][c]
                if p:
                    piece[at] = True
        self.link = [NONE] * len(self.edges)
        self.popped = [0] * len(self.edges)
        queue = deque((root, c, n) for root in (0, 1) for c, n in self.edges[root].items())
        while queue:
            parent, c, node = queue.popleft()
            if piece[node]:
                self.link[node], self.popped[node] = 1, 1
            else:
                # The parent's pieces, then those of what is left until c continues it.
                at, n = self.link[parent], self.popped[parent]
                while at != NONE and c not in self.edges[at]:
                    n += self.popped[at]
                    at = self.link[at]
                if at != NONE:
                    self.link[node], self.popped[node] = self.edges[at][c], n
            queue.extend((node, x, k) for x, k in self.edges[node].items())

    def count(self, word: str) -> int | None:
        """Pieces of a word; None if greedy longest match finds no split."""
        edges, link, popped = self.edges, self.link, self.popped
        at = n = 0
        for c in word:
            while c not in edges[at]:
                n += popped[at]
                at = link[at]
                if at == NONE:
                    return None
            at = edges[at][c]
        while at > 1:
            n += popped[at]
            at = link[at]
            if at == NONE:
                return None
        return n


def sentencepiece_vocabulary(path: str) -> tuple[list[str], list[str]]:
    """Pieces of a sentencepiece model that start a word (marked by U+2581) and
    that continue one; control, unknown and byte pieces are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    mark = "▁"
    return [p[1:] for p in pieces if p[0] == mark and len(p) > 1], [p for p in pieces if mark not in p]


def token_counts(
    docs: DataFrame,
    first: list[str],
    rest: list[str],
    id: str = "doc_id",
    text: str = "text",
    kept: int = 500_000,
) -> DataFrame:
    """``(id, n_words, n_tokens, n_unknown)`` per row.

    Words are runs of anything but ASCII white space.  A word that the vocabulary can't
    spell counts as one (unknown) token, also counted in ``n_unknown``.  A null or
    empty text has none of them.  Rows keep their number, repeated or not; an empty
    table gives no rows.

    A task keeps the counts of up to ``kept`` different words of at most 64
    characters; then it forgets them and begins anew.  Longer words are counted each
    time, in time linear in their length.
    """
    small_batches(docs.sparkSession)
    rows = narrow(docs, id, text).select(id, F.col(text).cast("binary").alias("_text"))
    schema = rows.drop("_text").schema
    for name in ("n_words", "n_tokens", "n_unknown"):
        schema = schema.add(name, "long")
    vocabulary = docs.sparkSession.sparkContext.broadcast((first, rest))  # as large as the vocabulary file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(*vocabulary.value)
        known: dict[bytes, int] = {}  # pieces, 0 for unknown words

        def count(word: bytes) -> int:
            n = automaton.count(word.decode("utf-8", "replace")) or 0
            if len(word) <= 64:
                known[word] = n
            return n

        for b in batches:
            out = []
            for t in b.column("_text").to_pylist():
                counts = [known[w] if w in known else count(w) for w in (t or b"").split()]
                unknown = counts.count(0)
                out.append((len(counts), sum(counts) + unknown, unknown))
                if len(known) > kept:
                    known.clear()
            columns = [pa.array(x, pa.int64()) for x in (zip(*out) if out else ([], [], []))]
            yield pa.RecordBatch.from_arrays([b.column(id), *columns], names=schema.names)

    return rows.mapInArrow(run, schema)
