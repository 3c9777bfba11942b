"""Main text of web pages by removal of what a site repeats.

Every page is read once into blocks: runs of text, each with the hash of the subtree of
the block element that holds it (its tag, its class and id, the hashes of the elements
and the texts inside).  Spark counts on how many different pages of a host each
subtree stands.  Subtrees that recur on many of them are the site's template and go; so do
menus, footers, forms and the like, which their tags, roles or names tell, since a site
with few pages repeats little.  What stays, in page order, is the text.

A page that stands in many copies repeats its own article, not a template.  So pages
that agree in all their text count once, and a subtree must recur on a good share of the
host's different pages.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from ledgerlens.llm.common import narrow, shared_table, small_batches
from ledgerlens.llm.url_filters import host_of

# A subtree is a host's template if it stands on so many of its different pages, and
# on so large a share of them.
PAGES, SHARE = 5, 0.5

# Elements by what they hold.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe xmp noembed noframes".split())
NEVER = RAW | frozenset("noscript template head svg object video audio canvas select button datalist dialog menu map".split())
ASIDE = frozenset("nav footer aside form".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BLOCKS = HEADINGS | ASIDE | NEVER | frozenset(
    "html body main article section div header p ul ol li dl dt dd table caption thead tbody tfoot tr td th blockquote pre "
    "figure figcaption address fieldset legend details summary hgroup center hr option".split()
)
# What the start of an element ends: open elements of these names, up to the nearest
# one that bounds them.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BOUNDS = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "option": set()}
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
# Words of a class or id that name something beside the article.
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar sidebars aside rail widget widgets "
    "nav navbar navigation navi menu menus breadcrumb breadcrumbs pagination pager toolbar topbar masthead header footer "
    "cookie cookies consent gdpr notice notices alert alerts disclaimer popup modal overlay paywall "
    "newsletter subscribe subscription signup login share sharing social related recommended recommendations teaser "
    "comment comments commentlist disqus respond reply replies form search".split()
)

BLOCK = ArrayType(StructType().add("hash", "long").add("text", "string"))
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"'=]++|=\s*+(?:"[^"]*"|'[^']*')?+|["'])*+)>""")
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_PARTS = re.compile(r"[A-Za-z][a-z]*|[^A-Za-z]+")


def _attributes(tail: str) -> dict[str, str]:
    return {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(tail)}


def _named(own: dict[str, str]) -> bool:
    """Whether role, class or id say that an element is no part of an article."""
    if own.get("role", "").strip().lower() in ROLES or own.get("aria-hidden", "").lower() == "true":
        return True
    if "display:none" in own.get("style", "").replace(" ", "").lower():
        return True
    words = (w.lower() for key in ("class", "id") for w in _PARTS.findall(own.get(key, "")))
    return not NAMES.isdisjoint(words)


class _Element:
    __slots__ = ("tag", "parts", "hash", "apart", "marked", "root", "prose")

    def __init__(self, tag: str, key: str, apart: int, marked: _Element | None, root: str) -> None:
        self.tag, self.parts, self.hash, self.prose = tag, [tag, key], 0, 0
        self.apart = apart  # open elements, with itself, that never hold text of an article
        self.marked = marked  # outermost element since the root that its name or tag sets aside
        self.root = root  # article, main or nothing


def blocks(page: str | None) -> list[tuple[int, str]]:
    """(subtree hash, text) of the blocks of a page's article, in page order.

    The article is what ``article`` elements hold, else ``main``, else the whole body.
    Character references are decoded, white space is one space, empty blocks are
    left out.  Elements end where their end tag or an enclosing one stands, where a
    sibling must end them, or with the page, so a cut page gives what it has; an
    unfinished tag or comment at its end says nothing.
    """
    page = page or ""
    top = _Element("", "", 0, None, "")
    stack, found, buffer = [top], [], []
    open_: dict[str, int] = {}
    headings = headers = 0  # open headings; open headers of an article

    def flush() -> None:
        if buffer:
            text = " ".join("".join(buffer).split())
            buffer.clear()
            if text:
                own = holder()
                own.parts.append(text)
                found.append((own, stack[-1].apart > 0 or (headers > 0 and headings == 0), stack[-1].marked, stack[-1].root, text))

    def holder() -> _Element:
        for e in reversed(stack):
            if e.tag in BLOCKS or e is top:
                return e
        return top

    def close() -> None:
        nonlocal headings, headers
        e = stack.pop()
        open_[e.tag] -= 1
        if e.tag in BLOCKS:
            e.hash = xxhash.xxh64_intdigest("\0".join(e.parts).encode("utf-8", "surrogatepass")) - (1 << 63)
            holder().parts.append(str(e.hash))
            headings -= e.tag in HEADINGS
            headers -= e.tag == "header" and e.root != ""
            if e.tag in ("p", "h1"):
                for x in stack:
                    x.prose += 3 if e.tag == "h1" else 1

    at, size = 0, len(page)
    while at < size:
        lt = page.find("<", at)
        if lt < 0:
            lt = size
        if lt > at:
            chunk = page[at:lt]
            buffer.append(entities.unescape(chunk) if "&" in chunk else chunk)
        if lt == size:
            break
        nxt = page[lt + 1 : lt + 3]
        if nxt[:1] == "!" or nxt[:1] == "?" or (nxt[:1] == "/" and not nxt[1:].isalpha()):
            if page.startswith("<!--", lt):
                end = page.find("-->", lt + 2 if page.startswith("<!-->", lt) else lt + 4)
                at = size if end < 0 else end + 3
            else:
                end = page.find(">", lt)
                at = size if end < 0 else end + 1
            continue
        m = _TAG.match(page, lt)
        if not m:
            if not (nxt[:1].isascii() and nxt[:1].isalpha()) and nxt[:1] != "/":
                buffer.append("<")
                at = lt + 1
            else:
                at = size  # a tag that the page's end cuts
            continue
        at, tag = m.end(), m[2].lower()
        if m[1]:
            if open_.get(tag, 0):
                if tag in BLOCKS:
                    flush()
                    while stack[-1].tag != tag:
                        close()
                    close()
                elif stack[-1].tag == tag:
                    close()
            elif tag == "br":
                buffer.append(" ")
            continue
        if tag in BLOCKS:
            flush()
            if open_.get("p", 0) and tag != "option":
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag == "p":
                        while len(stack) > k:
                            close()
                        break
                    if stack[k].tag in BLOCKS:
                        break
            if tag in ENDS and any(open_.get(x, 0) for x in ENDS[tag]):
                last = None
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag in BOUNDS[tag]:
                        break
                    if stack[k].tag in ENDS[tag]:
                        last = k
                while last and len(stack) > last:
                    close()
        elif tag == "br":
            buffer.append(" ")
        if tag in VOID:
            continue
        own = _attributes(m[3]) if "=" in m[3] else {}
        up = stack[-1]
        root, marked, named = up.root, up.marked, bool(own) and _named(own)
        if tag in ("article", "main") and not (root == "article" or named):
            root, marked = tag, None
        e = _Element(tag, f"{own.get('class', '')}\0{own.get('id', '')}" if own else "", up.apart + (tag in NEVER), marked, root)
        if marked is None and root != tag and tag not in ("html", "body"):
            if named or tag in ASIDE or (tag == "header" and root == "") or "hidden" in m[3].lower().split():
                e.marked = e
        stack.append(e)
        open_[tag] = open_.get(tag, 0) + 1
        headings += tag in HEADINGS
        headers += tag == "header" and root != ""
        if tag in RAW and not m[3].endswith("/"):
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.IGNORECASE).search(page, at)
            at = end.start() if end else size
    flush()
    while len(stack) > 1:
        close()

    roots = {f[3] for f in found} | ({"article"} if "article" in open_ else set()) | ({"main"} if "main" in open_ else set())
    root = "article" if "article" in roots else "main" if "main" in roots else ""

    def kept(marked: _Element | None) -> bool:
        # Without an article a wrapper of most of the page may have such a name.
        return marked is None or (root == "" and marked.prose >= 3 and marked.tag in ("div", "section", "form", "table"))

    return [(own.hash, text) for own, apart, marked, of, text in found if of == root and not apart and kept(marked)]


def page_blocks(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``(id, url, host, key, blocks)`` per row: the host of the url (empty if it has
    none), a hash of all the page's text, and ``array<struct<hash, text>>``."""
    small_batches(pages.sparkSession)
    rows = narrow(pages, id, url, html).select(
        F.col(id).alias("id"), F.col(url).alias("url"), host_of(F.col(url)).alias("host"), F.col(html).cast("binary").alias("html")
    )
    schema = rows.drop("html").schema.add("key", "long").add("blocks", BLOCK)
    kind = pa.list_(pa.struct([("hash", pa.int64()), ("text", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            read = [blocks(h.decode("utf-8", "replace") if h else "") for h in b.column("html").to_pylist()]
            keys = [xxhash.xxh64_intdigest("\0".join(t for _, t in p).encode("utf-8", "surrogatepass")) - (1 << 63) for p in read]
            out = pa.array([[{"hash": h, "text": t} for h, t in p] for p in read], kind)
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(keys, pa.int64()), out], names=schema.names)

    return rows.mapInArrow(run, schema)


def templates(blocked: DataFrame, least: int = PAGES, share: float = SHARE) -> DataFrame:
    """``(host, hashes)``: the subtrees that stand on at least ``least`` different pages
    of a host and on at least ``share`` of them.  Pages with the same text count once;
    those without a host belong to no site.

    Counts are taken per (host, page, subtree) first and then added up, so a host with a
    third of all pages is spread over all tasks.  A host's list is no longer than the
    subtrees of its average page divided by ``share``.
    """
    seen = blocked.where("host <> ''").select("host", "key", F.explode(F.array_distinct("blocks.hash")).alias("hash"))
    counts = seen.distinct().groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    sizes = blocked.where("host <> ''").select("host", "key").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    often = counts.join(sizes, "host").where(F.col("n") >= share * F.col("pages"))
    return often.groupBy("host").agg(F.collect_set("hash").alias("hashes"))


def extract(
    pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html", least: int = PAGES, share: float = SHARE
) -> DataFrame:
    """``(id, url, text, n_chars, n_blocks, n_template)`` per row of ``pages``, also
    repeated ones: the main text, its code points, the blocks it joins and those that
    went as the host's template.

    A null, empty or blank page, one without an article and one that is all template
    give an empty text.  Null ids and urls pass through.  Bytes that are no UTF-8 read as
    U+FFFD.  An empty table gives no rows.  Whole pages are read; other columns of
    ``pages`` are ignored, whatever their names.
    """
    blocked = shared_table(page_blocks(pages, id, url, html), "page-blocks")
    often = shared_table(templates(blocked, least, share), "templates")
    stays = F.filter("blocks", lambda b: ~F.coalesce(F.array_contains("hashes", b["hash"]), F.lit(False)))
    rows = blocked.join(often, "host", "left").select("id", "url", stays.alias("stays"), F.size("blocks").alias("all"))
    text = F.array_join(F.col("stays.text"), " ")
    rows = rows.select("id", "url", text.alias("text"), F.size("stays").cast("long").alias("n_blocks"), "all")
    return rows.select(
        F.col("id").alias(id), F.col("url").alias(url), "text", F.char_length("text").cast("long").alias("n_chars"),
        "n_blocks", (F.col("all") - F.col("n_blocks")).cast("long").alias("n_template"),
    )
