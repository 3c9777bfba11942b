"""Quality rules as a bitmask ledger, in DataFrame functions only.

Every rule is evaluated once per text.  The ledger keeps the measurements and one
``long`` of failure bits.  A policy is a named, versioned set of rules; applying it is
a bitwise AND of the ledger with the policy's mask, so a new policy needs no text.
Ablations (what each rule decides alone) aggregate the different bit patterns, of
which there are few, instead of the texts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import SPACES, WORD_CHAR, narrow

# Rule: the condition under which a text fails it.  A rule's bit is its place
# here; append new rules, never reorder.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "capitals": "2 * n_capitals > word_chars",
    "repeated_lines": "10 * n_dup_lines > 6 * n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_capitals", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Policy:
    """A text is kept if it fails none of ``rules``."""

    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << list(RULES).index(r) for r in self.rules)


BASE = Policy("base", 1, ("few_words", "repeated_words"))
FULL = Policy("full", 1, tuple(RULES))


def _only(text: Column, keep: str) -> Column:
    """Number of characters of a class."""
    return F.length(F.regexp_replace(text, f"[^{keep}]+", "")).cast("long")


def measure(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, *MEASURES)`` per row.  Words are runs of anything but ASCII white
    space; a null or empty text measures 0 throughout.

    ``n_repeat_words`` counts the words in three-word windows that occur twice or
    more in the text, first occurrences included.  Windows are compared by 64-bit
    hashes.  A text whose hashes are all different (a hash set tells) is done; else its
    windows are sorted by hash, and equal neighbours give the repeated places:
    n log n for a text of n words, in one row, without a shuffle.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = narrow(docs, id, text).select(id, whole.alias("_text"))
    rows = rows.select(
        id,
        F.array_remove(F.split("_text", SPACES), "").alias("_words"),
        F.filter(F.split("_text", "\n"), lambda l: l.rlike(WORD_CHAR)).alias("_lines"),
        _only(F.col("_text"), "#*$%&|<>").alias("n_symbols"),
        _only(F.col("_text"), r"\p{Lu}").alias("n_capitals"),
    )
    hashes = F.transform(
        F.sequence(F.lit(0), F.size("_words") - 3), lambda i: F.xxhash64(*(F.get(F.col("_words"), i + k) for k in range(3)))
    )
    rows = rows.select(
        id,
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        "n_capitals",
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("_words") >= 4, hashes).alias("_hashes"),
    )
    by_hash = F.sort_array(F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.select(
        id, *MEASURES[:-1], F.when(F.size(F.array_distinct("_hashes")) < F.size("_hashes"), by_hash).alias("_sorted")
    )

    def repeated(s: Column, k: Column) -> Column:
        near = [F.coalesce(F.get(F.col("_sorted"), k + d)["h"] == s["h"], F.lit(False)) for d in (-1, 1)]
        return near[0] | near[1]

    rows = rows.select(id, *MEASURES[:-1], F.filter("_sorted", repeated)["i"].alias("_at"))
    covered = F.array_distinct(F.flatten(F.transform("_at", lambda p: F.array(p, p + 1, p + 2))))
    return rows.select(id, *MEASURES[:-1], F.coalesce(F.size(covered), F.lit(0)).cast("long").alias("n_repeat_words"))


def ledger(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, *MEASURES, failed)``: one row per row of ``docs``, repeated rows and
    null ids included; ``failed`` has the bit of every rule that the text fails.
    An empty table gives an empty ledger."""
    bits = [F.when(F.expr(rule), F.lit(1 << k).cast("long")).otherwise(F.lit(0).cast("long")) for k, rule in enumerate(RULES.values())]
    failed = bits[0]
    for b in bits[1:]:
        failed = failed.bitwiseOR(b)
    return measure(docs, id, text).withColumn("failed", failed)


def passes(policy: Policy, failed: str = "failed") -> Column:
    return F.col(failed).bitwiseAND(F.lit(policy.mask).cast("long")) == 0


def ablations(entries: DataFrame, policy: Policy) -> DataFrame:
    """``(policy, version, rule, n_failed, n_only, kept_without)`` per rule of a
    policy: texts that fail it, that fail it and no other, and that the policy
    without it would keep.  Counts different bit patterns first, then rules."""
    patterns = entries.groupBy(F.col("failed").bitwiseAND(F.lit(policy.mask).cast("long")).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    rules = F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(1 << list(RULES).index(r)).cast("long").alias("bit")) for r in policy.rules))
    each = patterns.select("bits", "n", F.inline(rules))
    fails, alone = F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("bits") == F.col("bit")
    kept = alone | (F.col("bits") == 0)
    return each.groupBy(F.lit(policy.name).alias("policy"), F.lit(policy.version).alias("version"), "rule").agg(
        *(F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).alias(a) for a, c in (("n_failed", fails), ("n_only", alone), ("kept_without", kept)))
    )
