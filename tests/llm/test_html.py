import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from texts import prose

from tidemark.llm import htmltext as h

SCHEMA = "page_id long, url string, html string, host string, template string, text string, n_chars string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, t, "x", "x", "x", "x") for i, u, t in rows], SCHEMA)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain words", "plain words"),
        ("<p>a  b\n\tc</p><p> d </p>", "a b c\nd"),
        ("<p>one<p>two<div>three</div>four", "one\ntwo\nthree\nfour"),
        ("<p><b>bold.<br><p>next</b> end", "bold.\nnext end"),
        ("<p>a<br>b<i>c</i>d</p>", "a bcd"),
        ("&lt;p&gt; &amp; &eacute;&#233;&#xe9; &nbsp; &copy", "<p> & ééé ©"),
        ("a<script>var t='</p>'; <p>no</p></script>b", "ab"),
        ("<style>p{}</style><noscript>no</noscript><template>no</template>yes", "yes"),
        ("x<!-- <p>no</p> -->y<!-- open", "xy"),
        ("<title>no</title><body>yes", "yes"),
        ("<nav>no</nav><header>no</header><article><header><h1>T</h1></header><p>x</p><aside>no</aside></article><footer>no</footer>", "T\nx"),
        ("<form><p>no</p></form><button>no</button><select><option>no</select>yes", "yes"),
        ('<div class="ad">no</div><div class="ads-top">no</div><div id="sidebar">no</div><div class="cookie notice">no</div><p>yes', "yes"),
        ('<article><p>yes</p><section id="comments"><p>no</p></section><div class="reply comment">no</div></article>', "yes"),
        ('<article>yes<article class="comment">no</article></article>', "yes"),
        ('<div role="navigation">no</div><div role=banner>no</div><ul class="main-menu"><li>no</ul><p>yes', "yes"),
        ('<p hidden>no</p><p style="display: none">no</p><p aria-hidden="true">no</p>yes', "yes"),
        ('<body class="has-sidebar"><div class="with-sidebar"><main><p>yes</p></main></div></body>', "yes"),
        ("<div><p>out</p><main><p>in</p></main></div>", "in"),
        ("<p>out only</p><article></article>", "out only"),
        ("<ul><li>a<li>b</ul><table><tr><td>1<td>2<tr><td>3</table>", "a\nb\n1\n2\n3"),
        ("<p class='adored'>headers</p><p class=\"shadow\">kept</p>", "headers\nkept"),
        ("<article><h1>cut off</h1><p>mid", "cut off\nmid"),
        ("a < b and <3 c", "a < b and <3 c"),
        ('<img alt="a>b"><p title=\'x>y\'>t</p>', "t"),
        ("</p></div>stray<p>ok", "stray\nok"),
        ("<pre>a\n  b</pre>", "a b"),
        ("<ARTICLE><P>Upper</P></ARTICLE><NAV>no</NAV>", "Upper"),
    ],
)
def test_pages(page, text):
    assert h.extract(page) == text


def test_deep_and_broken_pages_end():
    assert h.extract("<div>" * 20000 + "x" + "</div>" * 20000) == "x"
    assert h.extract("<b>" * 5000 + "x</i>" * 5000).startswith("x")
    assert h.extract("<p" * 3000) == ""
    assert len(h.extract("<p>" + "word " * 200000)) == 999999


def site(rng, k, banner):
    """A page whose frame doesn't say what it is; only its recurrence does."""
    return f"<div class=q1><div>{banner}</div><div><span>Share this now</span></div></div><div class=z><p>{prose(rng, 30)}</p><p>A line that all pages quote.</p></div><div><div>page {k}</div></div>"


@pytest.mark.parametrize("hot", [1000, 1])
def test_recurring_subtrees_go_and_prose_stays(spark, monkeypatch, hot):
    monkeypatch.setattr(h, "HOT_SHARE", hot)
    rng = random.Random(0)
    rows = [(k, f"https://a.example/{k}", site(rng, k, "Welcome to A")) for k in range(30)]
    rows += [(100 + k, f"http://u@b.example:80/{k}?x", site(rng, k, "Welcome to B")) for k in range(4)]
    rows += [(200, None, "<p>no url</p>"), (201, "nonsense", None), (202, "https://a.example/x", ""), (0, rows[0][1], rows[0][2])]
    got = {}
    out = h.main_text(pages(spark, rows))
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    for r in out.collect():
        got.setdefault(r["page_id"], []).append(r["text"])
        assert r["n_chars"] == len(r["text"])
    assert sum(map(len, got.values())) == len(rows)
    for k in range(30):
        lines = got[k][0].split("\n")
        assert len(lines) == 3 and lines[1] == "A line that all pages quote." and lines[2] == f"page {k}"
    assert "Welcome to B" in got[100][0]  # too few pages to tell
    assert got[200] == ["no url"] and got[201] == [""] and len(got[0]) == 2


def test_counts_match_brute_force(spark):
    rng = random.Random(1)
    rows = [(k, f"https://{'ab'[k % 3 == 0]}.example/", site(rng, k, f"banner {k % 2}")) for k in range(60)]
    want = {}
    for host in "ab":
        own = [t for _, u, t in rows if u.startswith(f"https://{host}.")]
        c = Counter(x for t in own for x in h.subtrees(h.parse(t)))
        want[f"{host}.example"] = sorted(x for x, n in c.items() if n >= h.MIN_PAGES and n >= h.MIN_SHARE * len(own))
    got = h.templates(h.recurring(pages(spark, rows).withColumn("host", h.host_of(F.col("url"))))).collect()
    assert {r["host"]: sorted(r["template"]) for r in got} == {k: v for k, v in want.items() if v}
    assert h.main_text(pages(spark, [])).count() == 0


def test_rotating_banners_of_a_large_host_go(spark):
    """Three layouts and eight banners, none on half of the pages; copies of a page and a passage of some pages stay."""
    rng = random.Random(2)
    rows = [(k, "https://c.example/", f"<div><div>{('One', 'Two', 'Three')[k % 3]} layout</div><ul><li>banner {k % 8}</ul></div><div><p>{prose(rng, 20)}</p></div>") for k in range(400)]
    quoted = f"<div><p>{prose(rng, 20)}</p></div>"
    rows += [(400 + k, "https://c.example/", f"<div><div>by {prose(rng, 3)}</div></div>{quoted}") for k in range(30)]
    copy = f"<div>{prose(rng, 20)}</div>"
    rows += [(500 + k, "https://c.example/", copy) for k in range(40)]
    got = {r["page_id"]: r["text"] for r in h.main_text(pages(spark, rows)).collect()}
    assert not [k for k in range(400) if "layout" in got[k] or "banner" in got[k] or len(got[k].split()) != 20]
    assert all(len(got[400 + k].split("\n")) == 2 for k in range(30))
    assert {got[500 + k] for k in range(40)} == {copy[5:-6]}


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ('<div id="content" class="has-sidebar"><p>Real text.</p></div>', "Real text."),
        ('<p class="search">How to search.</p><div class="search">no</div>', "How to search."),
        ('<h2 class="comment">A comment on menus</h2><p class="advert">no</p>yes', "A comment on menus\nyes"),
        ('<div class="no-menu with-footer"><p>yes</p></div>', "yes"),
    ],
)
def test_names_of_things_near_or_told_of_delete_nothing(page, text):
    assert h.extract(page) == text


def test_templates_on_two_pages_of_five(spark):
    """Opaque names and tags that say nothing: a menu on 40 % of the pages, a notice of ten texts in one slot, a table and a list in the text."""
    rng = random.Random(4)
    menu = "<div class=x1><ul><li>Start<li>Prices<li>About us</ul></div>"
    rows = []
    for k in range(60):
        notice = f"<div class=x2><div class=x3><b>Note</b> offer number {k % 10}</div></div>"
        body = f"<div class=x4><p>{prose(rng, 25)}</p><table><tr><td>0<td>1</table><ul><li>first<li>{prose(rng, 2)}</ul></div>"
        rows.append((k, "https://d.example/", (menu if k % 5 < 2 else "") + notice + body + f"<div class=x5>by {prose(rng, 3)}</div>"))
    got = {r["page_id"]: r["text"].split("\n") for r in h.main_text(pages(spark, rows)).collect()}
    for lines in got.values():
        assert not [x for x in lines if x.startswith(("Start", "Prices", "About", "Note"))]
        assert len(lines) == 4 and len(lines[0].split()) == 25 and lines[1] == "first" and lines[3].startswith("by ")


def test_rare_notices_of_one_slot_go(spark):
    """Thirty texts in one slot, each on four pages: no text is on enough pages, but the slot is."""
    rng = random.Random(5)
    rows = [(k, "https://e.example/", f"<div class=s><div>offer {k % 30}</div></div><div class=t>{prose(rng, 12)}</div>") for k in range(120)]
    got = {r["page_id"]: r["text"] for r in h.main_text(pages(spark, rows)).collect()}
    assert all(len(t.split()) == 12 for t in got.values())
