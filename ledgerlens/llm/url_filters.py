"""URL filter: rules per host and path, and trust spread over the host graph.

Two rank vectors run over the links between hosts: trust flows from trusted seeds
along the links, distrust from blocked seeds against them (who links to a bad host is
suspect).  Both are personalised PageRank.  A host is blocked if its distrust
exceeds its trust by more than a threshold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import narrow, shared_table

Rule = tuple[str, str, str]  # verdict (allow, block), host, path

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z in lower
    case; empty for null or without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def best_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """``struct<rule, verdict>`` of the longest rule that fits, null if none does.
    A rule fits its host and all hosts below it, if the path starts with the rule's.
    Of equally long rules the first in alphabetical order counts."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), [-ord(c) for c in r[1] + r[2]])):
        fits = ((host == h) | F.endswith(host, F.lit(f".{h}"))) & F.startswith(path, F.lit(p))
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def host_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``(src, dst, n)``: links between different hosts, with their number.  Only
    absolute and protocol-relative targets name another host; relative ones stay
    on their own."""
    rows = narrow(pages, url, html).select(host_of(F.col(url)).alias("src"), F.coalesce(F.col(html), F.lit("")).alias("_html"))
    target = r"(?i)\bhref\s*=\s*[\"']?\s*((?:[a-z][a-z0-9+.\-]*:)?//[^\s\"'<>]+)"
    links = rows.where("src <> ''").select("src", F.explode(F.regexp_extract_all("_html", F.lit(target), F.lit(1))).alias("_to"))
    to = F.when(F.startswith("_to", F.lit("//")), F.concat(F.lit(":"), F.col("_to"))).otherwise(F.col("_to"))
    links = links.select("src", host_of(to).alias("dst")).where("dst <> '' and dst <> src")
    return links.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def propagate(links: DataFrame, seeds: DataFrame, damping: float = 0.85, rounds: int = 20) -> DataFrame:
    """``(host, trust, distrust)`` for all hosts that seeds or links name.

    ``links(src, dst, n)``; ``seeds(host, trusted, blocked)``: non-negative weights, of
    which each column is scaled to sum 1.  A host passes its rank on by number of
    links; what reaches a host without links out (for distrust: in) returns to the seeds.
    After ``rounds`` rounds the ranks are exact to ``damping ** rounds``.  Without
    links every seed keeps its share.  Ties don't arise; repeated links add up,
    links of a host to itself are ignored.

    A round is one join per direction with one row per host, and a sum that is taken
    partially before the shuffle, so a host with a third of all links is split.
    Each round is written to the shared folder.
    """
    links = links.where("src <> dst").groupBy("src", "dst").agg(F.sum("n").cast("double").alias("n"))
    # One edge list: kind 0 carries trust forward, kind 1 distrust backward.
    edges = links.select(F.lit(0).alias("kind"), F.col("src").alias("a"), F.col("dst").alias("b"), "n").unionByName(
        links.select(F.lit(1).alias("kind"), F.col("dst").alias("a"), F.col("src").alias("b"), "n")
    )
    out = edges.groupBy("kind", "a").agg(F.sum("n").alias("all"))
    edges = shared_table(edges.join(out, ["kind", "a"]).select("kind", "a", "b", (F.col("n") / F.col("all")).alias("w")), "edges")
    has_out = shared_table(edges.select("kind", "a").distinct().withColumn("out", F.lit(True)), "sources")
    kinds = F.array(
        F.struct(F.lit(0).alias("kind"), F.col("trusted").cast("double").alias("seed")),
        F.struct(F.lit(1).alias("kind"), F.col("blocked").cast("double").alias("seed")),
    )
    start = seeds.select(F.col("host").alias("a"), F.inline(kinds)).groupBy("kind", "a").agg(F.sum("seed").alias("seed"))
    start = start.unionByName(edges.select("kind", "a", F.lit(0.0).alias("seed"))).unionByName(
        edges.select("kind", F.col("b").alias("a"), F.lit(0.0).alias("seed"))
    )
    start = start.groupBy("kind", "a").agg(F.sum("seed").alias("seed"))
    start = shared_table(start, "seeds")
    sums = {r["kind"]: r["s"] for r in start.groupBy("kind").agg(F.sum("seed").alias("s")).collect()}  # two rows
    share = F.when(F.col("kind") == 0, F.col("seed") / F.lit(sums.get(0) or 1.0)).otherwise(F.col("seed") / F.lit(sums.get(1) or 1.0))
    base = start.select("kind", "a", share.alias("seed")).join(has_out, ["kind", "a"], "left")
    base = shared_table(base.withColumn("out", F.coalesce("out", F.lit(False))), "hosts")
    rank = base.withColumn("rank", F.col("seed"))
    for _ in range(rounds if not has_out.isEmpty() else 0):
        # Rank of hosts that pass nothing on; two rows.
        loose = {r["kind"]: r["s"] for r in rank.where(~F.col("out")).groupBy("kind").agg(F.sum("rank").alias("s")).collect()}
        back = F.when(F.col("kind") == 0, F.lit(loose.get(0, 0.0))).otherwise(F.lit(loose.get(1, 0.0)))
        sent = edges.join(rank.where("rank > 0").select("kind", "a", "rank"), ["kind", "a"])
        got = sent.groupBy("kind", F.col("b").alias("a")).agg(F.sum(F.col("rank") * F.col("w")).alias("got"))
        new = F.col("seed") * (1 - damping + damping * back) + damping * F.coalesce("got", F.lit(0.0))
        rank = shared_table(base.join(got, ["kind", "a"], "left").select("kind", "a", "seed", "out", new.alias("rank")), "ranks")
    return rank.groupBy(F.col("a").alias("host")).agg(
        F.sum(F.when(F.col("kind") == 0, F.col("rank")).otherwise(0.0)).alias("trust"),
        F.sum(F.when(F.col("kind") == 1, F.col("rank")).otherwise(0.0)).alias("distrust"),
    )


def judge(
    pages: DataFrame,
    rules: Sequence[Rule],
    id: str = "page_id",
    url: str = "url",
    html: str = "html",
    damping: float = 0.85,
    rounds: int = 20,
    threshold: float = 0.0,
) -> DataFrame:
    """``(id, host, path, rule, verdict, trust, distrust)`` per row of ``pages``.

    The rule's verdict stands; ``rule`` is null where none fits.  Else the host's is
    the method's: ``block`` if distrust exceeds trust by more than ``threshold``, else
    ``allow``, which an unknown, empty or null host therefore gets.  Seeds are the hosts of
    pages that a rule judges, weighted by number of pages; their ranks decide about
    their other pages and about the hosts that they link to, or that link to them.
    Rows keep their number, repeated or not; an empty table gives no rows.
    """
    rows = narrow(pages, id, url).select(id, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    rows = rows.withColumn("_best", best_rule(F.col("host"), F.col("path"), rules))
    by_rule = F.col("_best.verdict")
    seeds = rows.where("_best is not null").groupBy("host").agg(
        F.sum((by_rule == "allow").cast("int")).alias("trusted"), F.sum((by_rule == "block").cast("int")).alias("blocked")
    )
    ranks = propagate(shared_table(host_links(pages, url, html), "host-links"), seeds, damping, rounds)
    ranks = shared_table(ranks, "host-ranks")
    joined = rows.join(ranks, "host", "left")
    worse = F.coalesce(F.col("distrust") - F.col("trust") > threshold, F.lit(False))
    verdict = F.coalesce(by_rule, F.when(worse, F.lit("block")).otherwise(F.lit("allow")))
    return joined.select(
        id, "host", "path", F.col("_best.rule").alias("rule"), verdict.alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
