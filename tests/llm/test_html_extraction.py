import html
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import html_extraction as H
from ledgerlens.llm import queries as Q

SF = "/root/testdata/sf0.001"


class Plain(HTMLParser):
    """Brute force: all text inside article elements, tags of blocks as spaces."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.out = 0, []

    def handle_starttag(self, tag, attrs):
        self.depth += tag == "article"
        if tag not in ("b", "i", "a", "span"):
            self.out.append(" ")

    def handle_endtag(self, tag):
        self.depth -= tag == "article"
        if tag not in ("b", "i", "a", "span"):
            self.out.append(" ")

    def handle_data(self, data):
        if self.depth:
            self.out.append(data)


def text(page):
    return " ".join(t for _, t in H.blocks(page))


def test_whole_table_equals_brute_force(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").toPandas()
    got = {r.page_id: r for r in Q.op11_site_text(spark, SF).collect()}
    assert len(got) == len(pages)
    for p in pages.itertuples():
        parser = Plain()
        parser.feed(p.html if "</article>" in p.html else p.html[: p.html.rfind("<")])
        parser.close()
        want = " ".join("".join(parser.out).split())
        assert (got[p.page_id].text, got[p.page_id].n_chars, got[p.page_id].url) == (want, len(want), p.url)


ARTICLE = "<article><h1>Head &amp; line</h1><p>One <b>bo</b>ld.<p>Two&nbsp;\n three<br>four</p><ul><li>a<li>b</ul></article>"
WANT = "Head & line One bold. Two three four a b"


@pytest.mark.parametrize(
    "around",
    [
        "{}",
        "<html><head><title>T</title><style>p{{}}</style></head><body><nav>menu</nav>{}<footer>foot</footer>",
        "<header><h1>Site</h1></header><aside>side</aside>{}<form><input value=x><label>name</label></form>",
        "<div class='cookie-notice'>We use cookies</div><main>{}<div id='comments'><article class=comment><p>Nice!</p></article></div></main>",
        "<script>var a = '<article>no</article>';</script>{}<!-- <article>no</article> --><noscript>no</noscript>",
        "<div class='content-with-sidebar'>{}<div class=sidebar>x</div></div><div class='Ad-Slot'>buy</div>",
    ],
)
def test_what_stands_around_an_article(around):
    assert text(around.format(ARTICLE)) == WANT


@pytest.mark.parametrize(
    "inside",
    ["<div class='ad'>buy</div>", "<aside>see also</aside>", "<section id=comments><p>first!</p></section>", "<script>x()</script>", "<form>mail</form>",
     "<div role=navigation>up</div>", "<footer>by me</footer>", "<div hidden>no</div>", "<style>p{}</style>", "<svg><text>no</text></svg>"],
)
def test_what_stands_inside_an_article(inside):
    assert text(f"<article><p>One.</p>{inside}<p>Two.</p></article>") == "One. Two."


def test_heading_in_an_articles_header_stays():
    assert text("<article><header><h1>Title</h1><p>by me, today</p></header><p>Text.</p></article>") == "Title Text."


@pytest.mark.parametrize(
    "page, want",
    [
        (None, ""), ("", ""), (" \n", ""), ("plain text", "plain text"), ("a < b & c <3", "a < b & c <3"), ("<p>cut", "cut"),
        ("<article><p>one</p><p>tw", "one tw"), ("<article><p>one</p><p", "one"), ("<article>one<!-- never ends", "one"),
        ("<article>one <b title='a>b'>two</b></article>", "one two"), ("<article>caf&eacute; &#233;&#xe9; &amp", "café éé &"),
        ("<body><nav>only a menu</nav></body>", ""), ("<article></article><p>beside</p>", ""), ("<article>x<script>never ends", "x"),
        ("<p>one</br>two", "one two"), ("<article><table><tr><td>a<td>b<tr><td>c</table></article>", "a b c"),
        ("<?xml version='1.0'?><!DOCTYPE html><main>m</main>", "m"), ("</p></div><p>a</p></article>", "a"), ("<article>a<p>b</article>c", "a b"),
        ("<ARTICLE><P>A</P></ARTICLE>", "A"), ("<article>" + "<div>" * 3000 + "deep", "deep"),
    ],
)
def test_odd_pages(page, want):
    assert text(page) == want


def test_a_wrapper_by_a_template_name_is_kept_without_an_article():
    page = "<form id=form1><h1>Title</h1><p>One.</p><p>Two.</p></form><div class=ad>buy</div>"
    assert text(page) == "Title One. Two."


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_template_of_a_host_goes(spark):
    rows = []
    for i in range(12):
        rows.append((i, f"https://A.example/{i}", f"<article><p>story {i}</p><div>Follow us on all channels</div><p>end {i}</p></article>"))
        rows.append((100 + i, f"http://b.example/{i}", f"<div>Welcome to B</div><p>note {i}</p><div><a>Home</a> <a>About</a></div>"))
    rows += [(200, "http://few.example/1", "<article><p>x</p><div>Follow us on all channels</div></article>"), (201, None, "<p>no host</p>")]
    got = {r.page_id: r for r in H.extract(pages(spark, rows)).collect()}
    assert all(got[i].text == f"story {i} end {i}" and got[i].n_template == 1 for i in range(12))
    assert all(got[100 + i].text == f"note {i}" for i in range(12))
    # Other hosts, and pages without one, keep it.
    assert got[200].text == "x Follow us on all channels" and got[201].text == "no host"


def test_copies_of_a_page_are_no_template(spark):
    """Most pages of the host are one article in copies, others share a passage."""
    rows = [(i, "http://a.example/x", "<article><p>The same article.</p><p>Its end.</p></article>") for i in range(40)]
    rows += [(100 + i, "http://a.example/y", f"<article><p>{'Shared passage.' if i < 4 else i}</p><p>own {i}</p></article>") for i in range(12)]
    got = {r.page_id: r.text for r in H.extract(pages(spark, rows)).collect()}
    assert {got[i] for i in range(40)} == {"The same article. Its end."}
    assert got[100] == "Shared passage. own 0" and got[111] == "11 own 11"


def test_subtree_hashes_tell_structure_apart():
    one, two = H.blocks("<div class=a>x</div><div class=b>x</div>")
    assert one[0] != two[0]
    same = H.blocks("<div class=a> x </div>")
    assert same[0] == one


def test_odd_rows_and_columns(spark):
    rows = [(1, None, None), (1, None, None), (None, "http://h/", "<p>t</p>"), (2, "no scheme", "<p>" + "word " * 50_000 + "</p>"), (3, "http://h/", " ")]
    df = pages(spark, rows)
    for clash in ("id", "host", "key", "blocks", "text", "hashes", "HTML", "Url"):
        df = df.withColumn(clash, F.lit("clash")) if clash.lower() not in ("html", "url") else df.select("*", F.lit("clash").alias(clash))
    got = sorted(((r.page_id, r.url, len(r.text), r.n_chars) for r in H.extract(df).collect()), key=str)
    assert got == sorted([(1, None, 0, 0), (1, None, 0, 0), (None, "http://h/", 1, 1), (2, "no scheme", 249_999, 249_999), (3, "http://h/", 0, 0)], key=str)
    assert H.extract(pages(spark, [])).count() == 0


def test_bytes_that_are_no_utf8(spark):
    df = spark.sql("SELECT 1L AS page_id, 'http://h/' AS url, cast(X'3C703EFF613C2F703E' AS string) AS html")
    assert H.extract(df).first().text == "�a"


def test_references_match_the_standard_library():
    raw = "&lt;p&gt; &#128512; &hellip; &notit; &unknown; &am"
    assert text(f"<article>{raw}</article>") == html.unescape(raw)
