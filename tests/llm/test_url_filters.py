import re

from pyspark.sql import functions as F

from ledgerlens.llm.queries import URL_RULES
from ledgerlens.llm.url_filters import best_rule, host_links, host_of, judge, path_of, propagate


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = re.split(r"[?#]", url.split("://", 1)[1], maxsplit=1)[0]
    host, slash, path = rest.partition("/")
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), slash + path


def plain_rule(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


URLS = [
    None, "", "no scheme", "http://", "http://A.Example.NET/en/x?y#z", "https://example.net", "https://example.net?/en/",
    "http://x.net/a://b.org/fr/", "http://notnet/", "http://evilexample.com/de/", "ftp://example.com/de/1#/x", "http://É.ORG/fr/É",
    "http://org/fr/", "http://a.org/FR/", "://net/", "http://example.net/en", "http://sub.example.net/en/\nnext", "x://h#f/de/",
]


def test_parts_and_rules(spark):
    df = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    rows = df.select("url", host_of(F.col("url")).alias("h"), path_of(F.col("url")).alias("p"))
    rows = rows.withColumn("r", best_rule(F.col("h"), F.col("p"), URL_RULES))
    for r in rows.collect():
        assert (r.h, r.p) == plain_parts(r.url), r.url
        assert (tuple(r.r) if r.r else (None, None)) == plain_rule(r.h, r.p), r.url


def plain_rank(links, seeds, damping=0.85, rounds=20):
    """Personalised PageRank of one direction; hosts without links out give back."""
    hosts = {h for h, _ in seeds.items()} | {x for a, b in links for x in (a, b)}
    total = sum(seeds.values()) or 1.0
    seed = {h: seeds.get(h, 0) / total for h in hosts}
    rank, out = dict(seed), {}
    for (a, _), n in links.items():
        out[a] = out.get(a, 0) + n
    for _ in range(rounds):
        loose = sum(rank[h] for h in hosts if h not in out)
        got = dict.fromkeys(hosts, 0.0)
        for (a, b), n in links.items():
            got[b] += rank[a] * n / out[a]
        rank = {h: seed[h] * (1 - damping + damping * loose) + damping * got[h] for h in hosts}
    return rank


LINKS = {("good", "a"): 3, ("a", "b"): 1, ("b", "good"): 1, ("farm1", "bad"): 2, ("farm2", "bad"): 1, ("farm1", "farm2"): 4, ("a", "farm1"): 1, ("hub", "a"): 9}


def test_propagation_equals_a_plain_loop(spark):
    links = spark.createDataFrame([(a, b, n) for (a, b), n in LINKS.items()] + [("a", "a", 5)], "src string, dst string, n long")
    seeds = spark.createDataFrame([("good", 2, 0), ("lone", 1, 0), ("bad", 0, 1)], "host string, trusted long, blocked long")
    got = {r.host: (r.trust, r.distrust) for r in propagate(links, seeds).collect()}
    trust = plain_rank(LINKS, {"good": 2, "lone": 1})
    distrust = plain_rank({(b, a): n for (a, b), n in LINKS.items()}, {"bad": 1})
    assert set(got) == set(trust) | set(distrust)
    for h, (t, d) in got.items():
        assert abs(t - trust.get(h, 0)) < 1e-12 and abs(d - distrust.get(h, 0)) < 1e-12
    assert got["farm1"][1] > got["farm1"][0] and got["a"][0] > got["a"][1]


def test_verdicts_spread_over_links(spark):
    """A host that links to a blocked one is blocked; one that a trusted one links
    to, or that nobody knows, is allowed."""
    rows = [
        (1, "http://spam.net/x", "<p>"),
        (2, "http://farm.example/", '<a HREF = "http://SPAM.net/x">a</a> <a href=//spam.net/y>b</a>'),
        (3, "http://a.org/fr/", "<a href='https://friend.example/p?q#f'>"),
        (4, "http://friend.example/", '<a href="/own">'),
        (5, "http://unknown.example/", None),
        (6, None, '<a href="http://spam.net/">'),
        (6, None, None),
        (7, "http://example.com/de/", ""),
        (8, "http://example.com/en/", ""),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"URL_": F.lit(1), "trust": F.lit(1), "host": F.lit(2)})
    links = {(r.src, r.dst): r.n for r in host_links(pages).collect()}
    assert links == {("farm.example", "spam.net"): 2, ("a.org", "friend.example"): 1}
    got = sorted((r.page_id, r.rule, r.verdict) for r in judge(pages, URL_RULES).collect())
    assert got == [
        (1, "net/", "block"), (2, None, "block"), (3, "org/fr/", "allow"), (4, None, "allow"), (5, None, "allow"), (6, None, "allow"),
        (6, None, "allow"), (7, "example.com/de/", "block"), (8, None, "block"),
    ]


def test_empty(spark):
    assert judge(spark.createDataFrame([], "page_id long, url string, html string"), URL_RULES).collect() == []


def test_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    url = {r.page_id: r.url for r in pages.collect()}
    rows = judge(pages, URL_RULES).collect()
    assert len(rows) == len(url)
    for r in rows:
        assert (r.host, r.path) == plain_parts(url[r.page_id])
        rule, verdict = plain_rule(r.host, r.path)
        assert r.rule == rule and (verdict is None or r.verdict == verdict)
        assert verdict or r.verdict == ("block" if r.distrust > r.trust else "allow")
