"""Main text of web pages, without site templates.

A page becomes an element tree by a tolerant reader. Every subtree other than prose (paragraphs, headings, quotes), lines of
lists and tables and what holds an article is hashed twice: over its tags and text, and over its shape alone (tags, classes, children).
Spark counts by host on how many different pages each hash stands, and of each shape also how many texts it has. Deleted are

* subtrees that stand on ``MIN_PAGES`` pages or more and ``MIN_SHARE`` of their host's: menus, banners, notices, rotating ones, too;
  those that hold paragraphs or stand in an article only from half of the pages on (on large hosts ``ENOUGH_CAREFUL``);
* subtrees without paragraphs outside an article that recur at all (on two pages and ``SLOT_SHARE``), if their shape stands on half of the
  pages or more with few texts (a quarter as many at most): slots that are filled in turn.

What the counts can't tell (parts of small hosts, parts with a text of their own on each page) goes by what it says of itself:
navigation, headers outside the article, footers, asides, forms, scripts, styles, hidden parts, and elements whose class, id or
role names a menu, advert, notice, sidebar, comment section and the like. Where a page has article or main elements,
its text is what these hold. Prose inside an article is never deleted for recurring: a line that many articles quote is text.

Defined results: null and empty html give an empty text; a page without blocks gives an empty text; a page with a null url
or one without a host counts under the host ''; copies of a page on its host count once, and each gets its text; cut-off pages are read as far as they go; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import materialize, small_batches

#: A subtree is template if it stands on at least so many different pages of its host and on at least this share of them.
MIN_PAGES, MIN_SHARE = 5, 0.01
#: With paragraphs or in an article half of the pages; on larger hosts so many pages are enough, or this share if it is more.
HALF, ENOUGH_CAREFUL = 0.5, (50, 0.1)
#: A shape on half of the pages is a slot of the template if it has at most this share of texts; a text in it goes from two pages and this share on.
SLOT_TEXTS, SLOT_SHARE = 0.25, 0.001
PARAGRAPHS = frozenset("p blockquote pre".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*>?|<([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>?|<[!?/][^>]*>?", re.S)
ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style|itemprop)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=[\s/]|\Z)""", re.I)
WORD = re.compile(r"[a-z0-9]+")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img".split())
#: Parts that leave no gap in the line they stand in.
UNBROKEN = frozenset("script style noscript template button select input textarea svg math iframe object audio video canvas br".split()) | INLINE
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre br hr".split())
#: An opening tag ends those open elements of its set, up to the nearest element of the second.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
#: Lines of lists and tables: they go with their list or table, not one by one.
CELLS = frozenset("li td th tr dt dd option caption thead tbody tfoot".split())
SHUT = frozenset("nav footer aside form script style noscript template button select iframe svg math head title dialog menu textarea object canvas audio video map datalist xmp noembed noframes".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog alertdialog menu menubar toolbar".split())
NAMES = frozenset(
    "ad ads adbox advert adverts advertisement advertisements advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices notification alert popup modal overlay"
    " menu nav navbar navigation breadcrumb breadcrumbs sidebar aside widget widgets related recommended recommendations share sharing social comment comments commentlist respond replies disqus"
    " footer newsletter subscribe subscription signup login search pagination pager masthead topbar toolbar".split()
)
#: What a paragraph or heading must be named to be none of the article: other names may be its subject.
PROSE_NAMES = frozenset("ad ads advert adverts advertisement advertisements sponsored cookie cookies".split())
#: A class that begins so says what an element has near it or in what state it is, not what it is.
STATES = frozenset("has with without no not is js".split())
KEPT_WHOLE = frozenset(["html", "body", "main", "#root"])


class Node:
    __slots__ = ("attrs", "items", "main", "own_traits", "parent", "shape", "tag")

    def __init__(self, tag: str, attrs: str, parent: Node | None):
        self.tag, self.attrs, self.parent, self.items, self.main, self.own_traits, self.shape = tag, attrs, parent, [], False, None, 0


def parse(page: str) -> Node:
    """The element tree. What closes what is looked up in counts of open elements, so that deep nesting costs no more than flat."""
    root = node = Node("#root", "", None)
    open_: dict[str, int] = {}
    at = 0

    def close(upto: Node) -> Node:
        """Leave ``upto`` and all in it; its parent."""
        x = node
        while x is not upto.parent:
            open_[x.tag] -= 1
            x = x.parent
        return x

    def ended(tags: set[str], scope: set[str]) -> Node:
        """Where a tag goes that ends open elements of ``tags``, up to the nearest of ``scope``."""
        if not any(open_.get(t) for t in tags):
            return node
        x, last = node, None
        while x is not root and x.tag not in scope:
            if x.tag in tags:
                last = x
            x = x.parent
        return node if last is None else close(last)

    for m in iter(lambda: TOKEN.search(page, at), None):
        if m.start() > at:
            node.items.append(page[at : m.start()])
        at = m.end()
        if m[2]:
            tag = m[2].lower()
            if tag not in UNBROKEN:
                node = ended({"p"}, {"td", "th", "button", "table"})
            if tag in ENDS:
                node = ended(*ENDS[tag])
            new = Node(tag, m[3] or "", node)
            node.items.append(new)
            if tag in RAW:
                end = re.compile(f"</{tag}(?=[\\s/>]|\\Z)[^>]*>?", re.I).search(page, at)
                at = end.end() if end else len(page)
            elif tag not in VOID and not (m[3] or "").rstrip().endswith("/"):
                node = new
                open_[tag] = open_.get(tag, 0) + 1
        elif m[1] and open_.get(tag := m[1].lower()):
            x = node
            while x.tag != tag and not (tag in INLINE and x.tag not in INLINE):
                x = x.parent
            if x.tag == tag:
                node = close(x)
    if at < len(page):
        node.items.append(page[at:])
    return root


def traits(node: Node) -> dict[str, str]:
    if node.own_traits is None:
        node.own_traits = {k.lower(): v.strip("\"'").lower() for k, v in ATTRIBUTE.findall(node.attrs)} if node.attrs else {}
    return node.own_traits


def shut(node: Node, in_article: bool) -> bool:
    """Whether the element says that it is no part of the article."""
    if node.tag in SHUT or node.tag == "header" and not in_article:
        return True
    if node.tag in KEPT_WHOLE or not node.attrs:
        return False
    t = traits(node)
    if "hidden" in t or t.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", t.get("style", "")):
        return True
    names = [WORD.findall(name) for name in f"{t.get('class', '')} {t.get('id', '')}".split()]
    words = {w for name in names if name and name[0] not in STATES for w in name}
    if node.tag in PROSE:
        return t.get("role") in ROLES or bool(words & PROSE_NAMES)
    return t.get("role") in ROLES or bool(words & NAMES) or "header" in words and not in_article and node.tag != "article"


def is_main(node: Node) -> bool:
    if node.tag in ("article", "main"):
        return True
    t = traits(node)
    return t.get("role") == "main" or t.get("itemprop") == "articlebody"


def visit(root: Node) -> Iterator[tuple[str, object]]:
    """("in", node), ("out", node) and ("text", string) in page order, without recursion."""
    stack: list[tuple[str, object]] = [("in", root)]
    while stack:
        kind, x = stack.pop()
        yield kind, x
        if kind == "in":
            stack.append(("out", x))
            stack += [("text", i) if isinstance(i, str) else ("in", i) for i in reversed(x.items)]


def subtrees(root: Node) -> dict[int, list[Node]]:
    """The nodes of each subtree hash, each with its ``shape``: elements with text, other than prose, inline ones, lines of lists and tables and what holds an article.

    The lowest bit of a hash and a shape says whether the subtree holds paragraphs or stands in an article.
    """
    import xxhash

    inside, found = 0, {}
    open_: list[list] = []
    signed = lambda h, careful: (v - (1 << 64) if (v := h.intdigest() & ~1 | careful) >> 63 else v)
    for kind, x in visit(root):
        if kind == "in":
            x.main = is_main(x)
            inside += x.main
            shape = xxhash.xxh64(f"{x.tag} {traits(x).get('class', '')}")
            open_.append([xxhash.xxh64(x.tag), shape, False, x.tag in PARAGRAPHS, x.main, b""])
        elif kind == "text":
            if words := x.split():
                open_[-1][0].update("\x00" + " ".join(words))
                open_[-1][2] = True
        else:
            h, shape, text, prose, own, _ = open_.pop()
            inside -= own
            if text:
                shape.update(b"\x00")
            if open_:
                above = open_[-1]
                above[0].update(h.digest())
                if (digest := shape.digest()) != above[5]:  # children of one shape in a row count once
                    above[1].update(digest)
                    above[5] = digest
                above[2] |= text
                above[3] |= prose and text
                x.parent.main |= x.main
            if text and not x.main and x.tag not in PROSE and x.tag not in INLINE and x.tag not in KEPT_WHOLE and x.tag not in CELLS:
                careful = prose or inside > 0
                x.shape = signed(shape, careful)
                found.setdefault(signed(h, careful), []).append(x)
    return found


def extract(page: str | None, template: set[int] | None = None) -> str:
    """The page's blocks, a line each, without the subtrees whose hash is in ``template``."""
    if not page:
        return ""
    root = parse(page)
    gone = {id(n) for h, nodes in subtrees(root).items() if h in template for n in nodes} if template else set()
    whole, blocks = _blocks(root, gone)
    return "\n".join(blocks if blocks or whole else [])


def _blocks(root: Node, gone: set[int]) -> tuple[bool, list[str]]:
    inside, everywhere, roots = [], [], 0
    buffer: list[str] = []
    article = closed = 0

    def flush() -> None:
        if buffer:
            if text := " ".join(entities.unescape("".join(buffer)).split()):
                everywhere.append(text)
                if article:
                    inside.append(text)
            buffer.clear()

    for kind, x in visit(root):
        if kind == "text":
            if not closed:
                buffer.append(x)
        elif kind == "in":
            if closed or id(x) in gone or shut(x, article > 0) and not (x.main and x.tag not in ("article",) and x.tag not in SHUT):
                if not closed and x.tag not in UNBROKEN:
                    flush()
                closed += 1
                continue
            if x.tag == "br":
                buffer.append(" ")
            elif x.tag not in INLINE:
                flush()
            if is_main(x):
                article, roots = article + 1, roots + 1
        elif closed:
            closed -= 1
        else:
            if x.tag not in INLINE and x.tag != "br":
                flush()
            if is_main(x):
                article -= 1
    flush()
    return roots == 0, inside if inside else everywhere


def host_of(column) -> object:
    return F.lower(F.coalesce(F.regexp_extract(column, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


#: A host with more than this share of all pages is hot: there are HOT_SHARE at most. Its pages are dealt over parts of this share.
HOT_SHARE = 1000


def recurring(pages: DataFrame) -> DataFrame:
    """(host, h, shape, n): on how many different pages of its host each subtree stands; h = 0 counts pages."""
    import xxhash

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, hashes, shapes, names = [], [], [], []
            for host, page in zip(batch["host"].to_pylist(), batch["html"], strict=True):
                text = page.as_py() or ""
                found = subtrees(parse(text))
                own = [(0, 0), *{(h, n.shape) for h, nodes in found.items() for n in nodes}]  # 0 stands for the page itself
                names += [xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) >> 1] * len(own)
                hosts += [host] * len(own)
                hashes += [h for h, _ in own]
                shapes += [x for _, x in own]
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), *(pa.array(c, pa.int64()) for c in (hashes, shapes, names))], names=["host", "h", "shape", "page"])

    counts = pages.select("host", "html").mapInArrow(run, "host string, h long, shape long, page long").groupBy("host", "h", "shape").agg(F.count_distinct("page").alias("n"))
    return materialize(counts, "subtrees")


def templates(counts: DataFrame) -> DataFrame:
    """(host, template): the hashes of each host's recurring subtrees. At the shares asked for there are at most a hundred
    times as many as an average page of the host has subtrees, and in slots a thousand times."""
    total = counts.where("h = 0").select("host", F.col("n").alias("pages"))
    careful = F.col("h").bitwiseAND(1) == 1
    half = F.least(HALF * F.col("pages"), F.greatest(F.lit(ENOUGH_CAREFUL[0]), ENOUGH_CAREFUL[1] * F.col("pages")))
    recur = counts.where("h <> 0 and n > 1").join(total, "host").where(F.col("n") >= SLOT_SHARE * F.col("pages"))
    enough = (F.col("n") >= MIN_PAGES) & (F.col("n") >= F.when(careful, half).otherwise(MIN_SHARE * F.col("pages")))
    shapes = counts.where("h <> 0").where(~careful).groupBy("host", "shape").agg(F.sum("n").alias("n"), F.count("*").alias("texts")).where((F.col("n") >= MIN_PAGES) & (F.col("texts") <= SLOT_TEXTS * F.col("n")))
    slots = shapes.join(total, "host").where(F.col("n") >= HALF * F.col("pages")).select("host", "shape", F.lit(True).alias("slot"))
    many = recur.join(slots, ["host", "shape"], "left").where(enough | F.col("slot"))
    return many.groupBy("host").agg(F.collect_set("h").alias("template"))


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row.

    Pages meet their host's template by host; those of hot hosts, of which there can only be so many, by host and part.
    """
    pages = small_batches(pages).select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).withColumn("host", host_of(F.col("url")))
    counts = recurring(pages)
    sizes = counts.where("h = 0").select("host", "n")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    hot = F.broadcast(sizes.where(F.col("n") * HOT_SHARE >= total).select("host", F.ceil(F.col("n") * HOT_SHARE / total).cast("int").alias("parts")))  # HOT_SHARE rows at most
    parts = F.coalesce("parts", F.lit(1))
    left = pages.join(hot, "host", "left").select("page_id", "url", "html", "host", F.pmod(F.xxhash64("page_id", "url"), parts).cast("int").alias("part"))
    right = templates(counts).join(hot, "host", "left").select("host", "template", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(p.as_py(), set(t.as_py() or ())) for p, t in zip(batch["html"], batch["template"], strict=True)]
            yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return left.join(right, ["host", "part"], "left").select("page_id", "url", "html", "template").mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
