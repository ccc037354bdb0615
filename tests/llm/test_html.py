"""Main text of pages: markup zones, the suffix array per host, edge rows."""

import random

import pytest

from cadenza.llm import html_extract
from cadenza.llm.html_blocks import CHROME, DOUBT, MAIN, OPEN, blocks
from cadenza.llm.queries import op1_html_suffix_array
from helpers import HAVE_TABLES, SF, duck

SCHEMA = "page_id long, url string, html string"


@pytest.mark.parametrize("html,want", [
    ("<p>a &amp;lt;&nbsp; b</p>", [(OPEN, "a &lt; b")]),
    ("<article><h1>T</h1><p><b>one<br><p>two</article><footer>f", [
        (MAIN, "T"), (MAIN, "one"), (MAIN, "two"), (CHROME, "f")]),
    ('<p>1<script>var a="</p><p>z";</script>2<!-- <p>no</p> --></p>', [(OPEN, "12")]),
    ('<main><p class="notice">n<p>y<div id="newsletter-form">q</div>z</main>tail', [
        (CHROME, "n"), (MAIN, "y"), (CHROME, "q"), (MAIN, "z"), (OPEN, "tail")]),
    ('<article><header><h1>T</h1></header>x<section class=comments><article>c</article></section>y</article>',
     [(MAIN, "T"), (MAIN, "x"), (CHROME, "c"), (MAIN, "y")]),
    ('<header>top</header><div role="navigation">n</div><a href="x>y">l</a>k<aside>s</aside>', [
        (CHROME, "top"), (CHROME, "n"), (OPEN, "lk"), (CHROME, "s")]),
    ("<form>f<p>g</form><ul><li>a<li>b</ul><table><tr><td>c<td>d</table>", [
        (CHROME, "f"), (CHROME, "g"), (OPEN, "a"), (OPEN, "b"), (OPEN, "c"), (OPEN, "d")]),
    ('<div class="page no-sidebar">in</div><DIV CLASS=\'Ad\'>x<div>y</div>z</DIV>o', [
        (OPEN, "in"), (CHROME, "x"), (CHROME, "y"), (CHROME, "z"), (OPEN, "o")]),
    ("a < b &bogus; &#x41;&#66; \x00", [(OPEN, "a < b &bogus; AB \x00")]),
    ("<title>t</title><style>s</style><textarea>u</textarea>", []), ("", [])])
def test_blocks(html, want):
    assert blocks(html) == want


@pytest.mark.parametrize("html,want", [
    ("<html><head><title>x</title><body><article><p>Hello world</p></article>", [(MAIN, "Hello world")]),
    ("<head><meta charset=utf-8><link rel=x><p>one<nav>n</nav>", [(OPEN, "one"), (CHROME, "n")]),
    ("<head> <title>t</title> bare text<p>two", [(OPEN, "bare text"), (OPEN, "two")]),
    ("<head><style>s</style></head><p>a", [(OPEN, "a")])])
def test_head_without_end_tag(html, want):
    assert blocks(html) == want


@pytest.mark.parametrize("name,zone", [
    ("share-price", DOUBT), ("rail-transport", DOUBT), ("related-work", DOUBT), ("alert-level", DOUBT),
    ("ad", CHROME), ("ad-slot-3", CHROME), ("comment-list", CHROME), ("relatedPosts", CHROME),
    ("newsletter signup-form", CHROME), ("lead", MAIN), ("no-sidebar", MAIN)])
def test_class_words_inside_an_article(name, zone):
    assert blocks(f'<article>a<div class="{name}">b<p>c</div>d</article>') == [
        (MAIN, "a"), (zone, "b"), (zone, "c"), (MAIN, "d")]
    outside = CHROME if zone == DOUBT else OPEN if zone == MAIN else zone
    assert blocks(f'<div class="{name}">b</div>') == [(outside, "b")]


def test_labels():
    assert blocks("<article>a<label>b</label><form><label>c</label></form>d</article><label>e</label>") == [
        (MAIN, "a"), (MAIN, "b"), (CHROME, "c"), (MAIN, "d"), (CHROME, "e")]


def test_the_array_decides_on_hinting_classes(spark):
    same = " ".join(f"d{n}" for n in range(15))
    html = '<article>story {0}<div class="share-price">{1}</div>end</article>'.format
    rows = [(i, "http://h/", html(i, same)) for i in (0, 1)]
    rows += [(2, "http://h/", html(2, " ".join(f"price{n}" for n in range(15)))), (3, "http://one/", html(3, same)),
             (4, None, html(4, same))]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["page_id"]: r["text"] for r in html_extract.extract(df).collect()}
    assert got == {0: "story 0 end", 1: "story 1 end", 3: f"story 3 {same} end", 4: f"story 4 {same} end",
                   2: "story 2 " + " ".join(f"price{n}" for n in range(15)) + " end"}
    assert sorted(got.items()) == _brute(rows, html_extract.RUN)
    longer = {r["page_id"]: r["text"] for r in html_extract.extract(df, min_run=16).collect()}
    assert longer[0] == f"story 0 {same} end"  # nothing in the array: the text is another


@pytest.mark.parametrize("html,want", [
    ('<article>wo<svg width="1"/>rd <math/>b<p>c</article>d', [(MAIN, "word b"), (MAIN, "c"), (OPEN, "d")]),
    ("<article>a<svg><g><svg>x</svg>y</g>z</svg>b</article>c", [(MAIN, "ab"), (OPEN, "c")]),
    ("<p>a<object>x<object>y</object>z</object>b</p>", [(OPEN, "ab")]),
    ("<ul><li>a<object><li>x</object>b</ul>", [(OPEN, "ab")]),
    ("<svg><title/><style/><script href='s'/><text>x</text></svg>a", [(OPEN, "a")]),
    ("<svg class=ad><foreignObject><p>x<div>y</div></foreignObject></svg>a", [(OPEN, "a")]),
    ("<article><p>a<svg><g>x</p><p>b<p><svg>x<p>c<b>d<svg></b>e<svg></article>f", [
        (MAIN, "a"), (MAIN, "b"), (MAIN, "cde"), (OPEN, "f")]),
    ("<article>so <math><semantics><mrow><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mi>y</mi></mfrac></mrow>"
     "<annotation>tex</annotation></semantics></math> holds</article>", [(MAIN, "so x=1y holds")]),
    ("<nav><math><mi>x</mi></math></nav><math class=ad><mi>y</mi><b>z", [(CHROME, "x"), (CHROME, "y"), (OPEN, "z")])])
def test_svg_math_and_object(html, want):
    assert blocks(html) == want


@pytest.mark.parametrize("html", ["<svg>" * 20_000, "<svg><p>" * 20_000, "<math><mi>" * 20_000, "<svg/>" * 20_000])
def test_many_svg_are_linear(html):
    blocks(html)


@pytest.mark.parametrize("html", ['<a "' * 30_000, "<!--" * 50_000, "<div>" * 20_000 + "</p>" * 20_000,
                                  "<" * 100_000, "&" * 100_000, "<script>" * 20_000])
def test_broken_markup_is_linear(html):
    blocks(html)


def _brute(pages, run):
    """Text of each page by comparing every token window with every other page's."""
    hosts = {}
    parsed = [(i, (url or "").split("/")[2].lower() if url else None, blocks(html or ""))
              for i, url, html in pages]
    for _, host, page in parsed:
        tokens = tuple(t for zone, text in page if zone != MAIN for t in text.split(" "))
        for k in range(len(tokens) - run + 1):
            hosts.setdefault((host, tokens[k:k + run]), set()).add(tuple(page))
    out = []
    for i, host, page in parsed:
        tokens = [(k, t) for k, (zone, text) in enumerate(page) if zone != MAIN for t in text.split(" ")]
        hidden = set()
        if host:
            for k in range(len(tokens) - run + 1):
                if len(hosts[host, tuple(t for _, t in tokens[k:k + run])]) > 1:
                    hidden.update(range(k, k + run))
        left = [(k, t) for n, (k, t) in enumerate(tokens) if n not in hidden]
        kept = []
        for k, (zone, text) in enumerate(page):
            kept.append(text if zone == MAIN else
                        " ".join(t for b, t in left if b == k) if zone in (OPEN, DOUBT) else "")
        out.append((i, " ".join(x for x in kept if x)))
    return sorted(out, key=repr)


def test_suffix_array_matches_brute_force(spark):
    rng = random.Random(6)
    word = lambda n: " ".join(f"w{rng.randrange(40)}" for _ in range(n))
    shared = [word(9) for _ in range(4)]
    pages = []
    for i in range(60):
        body = [f"<p>{word(rng.randrange(1, 14))}</p>" for _ in range(3)]
        body.insert(rng.randrange(4), f"<div>{rng.choice(shared)} {word(3)}</div>")
        if i % 5 == 0:
            body.append(f"<article>{rng.choice(shared)}</article>")
        if i % 7 == 0:
            body.append(f"<footer>{rng.choice(shared)}</footer>")
        pages.append((i, f"http://{'hot' if i % 3 else 'h' + str(i % 4)}.example.org/{i}", "".join(body)))
    pages += [(60, pages[0][1], pages[0][2]), (0, pages[0][1], pages[0][2])]
    got = html_extract.extract(spark.createDataFrame(pages, SCHEMA), min_run=4).collect()
    assert sorted(((r["page_id"], r["text"]) for r in got), key=repr) == _brute(pages, 4)
    assert all(r["n_chars"] == len(r["text"]) for r in got)


def test_pages_that_differ_in_the_article_only(spark):
    same = " ".join(f"d{n}" for n in range(15))
    html = "<nav>menu</nav><div>{}</div><article>{}</article><footer>foot</footer>".format
    rows = [(i, "http://h/", html(same, f"story {i}")) for i in range(3)]
    rows += [(i, "http://copies/", html(same, "story")) for i in (3, 4)]
    got = html_extract.extract(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["page_id"]: r["text"] for r in got} == {
        0: "story 0", 1: "story 1", 2: "story 2", 3: f"{same} story", 4: f"{same} story"}


@pytest.mark.parametrize("tag", ["main", 'div role="main"', 'div id="main-content"'])
def test_repeated_blocks_of_main_are_boilerplate(spark, tag):
    same = " ".join(f"d{n}" for n in range(15))
    html = "<{0}><header>head {2}</header>{1}<div>{3}</div></{4}>".format
    rows = [(i, "http://h/", html(tag, f"<article>story {i} {same}</article>", i, same, tag.split()[0]))
            for i in (0, 1)]
    rows += [(i, "http://m/", html(tag, f"<p>story {i}</p>", i, same, tag.split()[0])) for i in (2, 3)]
    rows += [(4, None, html(tag, "<p>story 4</p>", 4, same, tag.split()[0]))]
    got = html_extract.extract(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["page_id"]: r["text"] for r in got} == {
        0: f"head 0 story 0 {same}", 1: f"head 1 story 1 {same}",
        2: "head 2 story 2", 3: "head 3 story 3", 4: f"head 4 story 4 {same}"}


def _site_brute(pages, run):
    """Article text of each page without what more than half of its host's articles hold."""
    arts = [(i, url.split("/")[2], tuple(t for z, x in blocks(html) if z == MAIN for t in x.split(" ")))
            for i, url, html in pages]
    out = {}
    for i, host, own in arts:
        others = {a for _, h, a in arts if h == host}
        hidden = set()
        for k in range(len(own) - run + 1):
            n = sum(any(a[j:j + run] == own[k:k + run] for j in range(len(a) - run + 1)) for a in others)
            if len(others) >= 16 and 2 * n > len(others):
                hidden.update(range(k, k + run))
        cut = 2 * len(hidden) <= len(own)
        out[i] = " ".join(t for k, t in enumerate(own) if not (cut and k in hidden))
    return out


def test_the_array_judges_article_text(spark):
    rng = random.Random(3)
    word = lambda n: " ".join(f"w{rng.randrange(400)}" for _ in range(n))
    notice, series, half = word(14), word(15), word(13)
    pages = []
    for i in range(120):
        host = ("site", "small", "copies")[i % 3] if i < 90 else "site"
        if host == "small" and i > 45:
            continue
        parts = [word(rng.randrange(20, 40)), word(20)]
        if host == "copies":
            parts[0] = f"{'same ' * 30}{i}"
        parts.insert(rng.randrange(3), notice if i % 7 else word(5))
        if i % 5 == 0:
            parts.append(series)
        if i % 2:
            parts.append(half)
        pages.append((i, f"http://{host}/{i}", "<nav>n</nav><article>" + "".join(
            f"<p>{p}</p>" for p in parts) + "</article>"))
    pages += [(1000 + n, f"http://site/copy{n}", pages[0][2] + f"<footer>{n}</footer>") for n in range(80)]
    got = {r["page_id"]: r["text"] for r in html_extract.extract(spark.createDataFrame(pages, SCHEMA)).collect()}
    assert got == _site_brute(pages, html_extract.RUN)
    text = {i: " ".join(t for z, t in blocks(h) if z == MAIN) for i, _, h in pages}
    cut = {i for i in got if got[i] != text[i]}
    assert notice in text[3] and notice not in got[3] and notice in got[1] and series in got[0]
    assert cut and all("//site/" in u for i, u, _ in pages if i in cut and "//copies/" not in u)


def test_edge_rows(spark):
    long = "<p>" + "long " * 200_000 + "</p>"
    rows = [(1, None, "<p>x</p>", 1, "q"), (2, "http://a.b/", None, 1, "q"), (None, "/relative", "<p>y", 1, "q"),
            (2, "http://a.b/", None, 1, "q"), (5, "HTTP://U@A.B:8080/x", long, 1, "q"), (6, "", "", 1, "q")]
    got = html_extract.extract(spark.createDataFrame(rows, SCHEMA + ", host int, text string")).collect()
    assert sorted((r["page_id"] or 0, r["n_chars"]) for r in got) == [
        (0, 1), (1, 1), (2, 0), (2, 0), (5, 999_999), (6, 0)]
    assert html_extract.extract(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.skipif(not HAVE_TABLES, reason="test tables missing")
def test_query(spark):
    pages = duck().execute("SELECT page_id, url, html FROM pages").fetchall()
    got = op1_html_suffix_array(spark, SF).collect()
    assert sorted(((r["page_id"], r["text"]) for r in got), key=repr) == _brute(pages, html_extract.RUN)
    for r in got:
        html = next(h for i, _, h in pages if i == r["page_id"])
        inside = html[html.index("<article>"):html.index("</article>")]
        assert r["text"] == " ".join(t for _, t in blocks(inside))
