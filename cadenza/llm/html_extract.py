"""Main text of web pages: block zones and a suffix array per host.

Markup decides where it speaks: blocks inside an article stay, menus, footers,
adverts and the like go (``html_blocks``). What markup leaves open is decided by
repetition, in <main> too where no article is around, and so is what stands in an
article under a class name that only hints at chrome. The token streams of a host's pages (all blocks but those sure to be article)
are concatenated, and every suffix is entered under host and first ``RUN``
tokens. Equal entries are the neighbours of the sorted array whose common prefix
has ``RUN`` tokens or more, so entries met on two different pages mark exactly
the substrings of that length repeated across pages; the union of the marked
stretches is every repeated substring of at least ``RUN`` tokens. Open blocks
lose the covered tokens and keep the unique runs.

Article tokens are a second stream of the array. Lines of articles recur on a few
pages (quotes, series), so two pages prove nothing there: an article loses a stretch
whose entries stand in more than half of the host's different articles, of which there
are ``SITE_ARTICLES`` or more - a notice or advert on the whole site - and keeps its
whole text where such stretches are more than half of it (near copies of one article).
One row per article token would be some four times the input. Every window of ``RUN``
tokens holds a least hash of its runs of ``GRAM`` tokens, and a window in more than half
of the articles has one in as many, so these are counted first, a fifth as many, and
windows are entered only where theirs is that frequent. Nothing is lost by it.

Only the smallest and largest page of an entry are kept, and they are combined
before the shuffle: a host with a third of all pages or boilerplate on every
page is never gathered in one place.
"""

from __future__ import annotations

from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.llm.common import add_columns, mix64, sized_broadcast, slices, stored
from cadenza.llm.html_blocks import CHROME, DOUBT, MAIN, OPEN, blocks

RUN = 12  # tokens of the shortest repeated substring that counts as boilerplate
GRAM = 4  # tokens of the runs whose least hash stands for a window of an article
SMALL = 1_000_000  # rows of a table that is broadcast
SITE_ARTICLES = 16  # different articles of a host from which on the array judges inside them
UNCLEAR = (OPEN, DOUBT)  # zones that the array decides
_OUTSIDE, _LEAST, _ARTICLE = 0, 1, 2  # rows of the array: suffix, least hash, article


def host_of(url: Column) -> Column:
    """Lower-case host of a URL without user and port; null without one."""
    host = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(host != "", F.lower(host))


def _stream(page, inside: bool = False) -> tuple[list[int], list[str]]:
    """Block and text of each token outside articles (``inside``: of articles), in page order."""
    where, tokens = [], []
    for k, (zone, text) in enumerate(page):
        if (zone == MAIN) == inside:
            own = text.split(" ")
            where += [k] * len(own)
            tokens += own
    return where, tokens


def _entries(host: str, tokens: list[str], run: int) -> np.ndarray:
    """Array entry of each suffix of ``run`` tokens or more: a hash of host and these."""
    size = len(tokens) - run + 1
    if size <= 0:
        return np.zeros(0, np.int64)
    one = np.array([xxhash.xxh3_64_intdigest(t) for t in tokens], dtype=np.uint64)
    total = np.full(size, xxhash.xxh3_64_intdigest(host), dtype=np.uint64)
    for k in range(run):
        total = mix64(total + one[k:k + size])
    return total.view(np.int64)


def _article(host: str, page, run: int) -> tuple[np.ndarray, np.ndarray]:
    """Entry of each suffix of the article stream, and its least hash of ``GRAM`` tokens."""
    _, tokens = _stream(page, inside=True)
    host += "\x00article"  # never equal to an entry outside articles
    own, gram = _entries(host, tokens, run), min(GRAM, run)
    least = _entries(host, tokens, gram)
    size = len(own)
    low = least[:size].copy()
    for k in range(1, run - gram + 1):
        np.minimum(low, least[k:k + size], out=low)
    return own, low


def _article_key(page) -> int:
    """Identity of an article: pages that differ around it only hold one article."""
    return _page_key([block for block in page if block[0] == MAIN])


def _page_key(page) -> int:
    """Identity of a page: copies of all its blocks, articles included, are one page."""
    return xxhash.xxh3_64_intdigest("\x00".join(f"{zone}{text}" for zone, text in page)) - (1 << 63)


def _array(pages: DataFrame, min_run: int) -> DataFrame:
    """(place, host, entry, page): the suffixes outside articles of every page with a
    host, the least hashes of its article and the article itself.

    A row without entry stands for each page that has unclear blocks.
    """
    def run(batches):
        for batch in slices(batches):
            rows = []
            for number, host, html in zip(*(batch.column(c).to_pylist() for c in ("number", "host", "html"))):
                page = blocks(html or "", main=OPEN)
                own, key = _entries(host, _stream(page)[1], min_run), _page_key(page)
                rows.append((_OUTSIDE, number, own, key))
                _, least = _article(host, page, min_run)
                if len(least):
                    rows.append((_LEAST, number, np.unique(least), 0))
                    rows.append((_ARTICLE, number, np.array([_article_key(page)]), 0))
                if any(zone in UNCLEAR for zone, _ in page):
                    rows.append((_OUTSIDE, None, None, 0))
            sizes = [1 if r[2] is None else len(r[2]) for r in rows]
            lost = np.repeat([r[2] is None for r in rows], sizes)
            entries = [np.zeros(1, np.int64) if r[2] is None else r[2] for r in rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.array([r[0] for r in rows], np.int32), sizes)),
                 pa.array(np.repeat(np.array([r[1] or 0 for r in rows], np.int64), sizes)),
                 pa.array(np.concatenate(entries), mask=lost),
                 pa.array(np.repeat(np.array([r[3] for r in rows], np.int64), sizes))],
                ["place", "number", "entry", "page"])

    return pages.where("host is not null").select("number", "host", "html").mapInArrow(
        run, "place int, number long, entry long, page long")


def _site_wide(pages: DataFrame, array: DataFrame, min_run: int) -> DataFrame | None:
    """(number, entry) of the article windows in more than half of a host's articles; None without any."""
    sites = stored(array.where(F.col("place") == _ARTICLE).groupBy("number").agg(
        F.count(F.lit(1)).alias("articles")).where(F.col("articles") >= SITE_ARTICLES))
    near = stored(array.where(F.col("place") == _LEAST).join(sized_broadcast(sites, SMALL), "number")
                  .where(2 * F.col("n") > F.col("articles")).select("number", "articles", "entry"))
    if near.isEmpty():
        return None

    def run(batches):
        for batch in slices(batches):
            for number, host, html in zip(*(batch.column(c).to_pylist() for c in ("number", "host", "html"))):
                page = blocks(html or "", main=OPEN)
                own, least = _article(host, page, min_run)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(own), number)), pa.array(own), pa.array(least),
                     pa.array(np.full(len(own), _article_key(page)))], ["number", "window", "entry", "article"])

    windows = (pages.join(sized_broadcast(near.select("number").distinct(), SMALL), "number", "left_semi")
               .select("number", "host", "html").mapInArrow(
                   run, "number long, window long, entry long, article long"))
    found = stored(windows.join(sized_broadcast(near, SMALL), ["number", "entry"])
                   .groupBy("number", "window", "articles", "article").agg(F.lit(1))
                   .groupBy("number", "window", "articles").agg(F.count(F.lit(1)).alias("n"))
                   .where(2 * F.col("n") > F.col("articles")).select("number", F.col("window").alias("entry")))
    return None if found.isEmpty() else found


def _left(page, covered: list[int], run: int, inside: bool) -> tuple[dict[int, str], bool]:
    """Text left of each block of a stream covered at the given suffixes; whether most of it is covered."""
    where, tokens = _stream(page, inside)
    hidden = np.zeros(len(tokens) + 1, np.int64)
    for at in covered:
        hidden[at] += 1
        hidden[min(at + run, len(tokens))] -= 1
    hidden = np.cumsum(hidden)[:len(tokens)] > 0
    left = {k: " ".join(t for _, t, h in own if not h)
            for k, own in groupby(zip(where, tokens, hidden), key=lambda x: x[0])}
    return left, 2 * int(hidden.sum()) > len(tokens)


def _unmarked(page, covered: set[int], run: int) -> str:
    """Text of a page covered at the given suffixes; those of its articles count down from -1."""
    left, _ = _left(page, [at for at in covered if at >= 0], run, False)
    article, most = _left(page, [-1 - at for at in covered if at < 0], run, True)
    texts = ((text if most else article[k]) if zone == MAIN else left[k] if zone in UNCLEAR else ""
             for k, (zone, text) in enumerate(page))
    return " ".join(t for t in texts if t)


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html", min_run: int = RUN) -> DataFrame:
    """``id_col``, ``url_col``, ``text`` and ``n_chars`` of every row.

    A null html is empty; a page without main text has the empty text. A page
    without a host is judged by its markup alone, its open blocks stay. Copies of
    a page (all its blocks are equal, articles included) are one page of its host,
    so they are not boilerplate of each other. An article loses what more than half of
    its host's articles hold. ``min_run`` is the number of tokens
    a repeated substring has at least; repeated rows come back repeated. Other
    columns are not read.
    """
    pages = df.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"),
                      host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html")
                      ).withColumn("number", F.xxhash64("host"))
    frequent = F.when(F.col("place") == _LEAST, 2 * F.col("n") > SITE_ARTICLES).otherwise(
        (F.col("place") == _ARTICLE) | F.col("entry").isNull() | (F.col("low") != F.col("high")))
    array = stored(_array(pages, min_run).groupBy("place", "number", "entry").agg(
        F.min("page").alias("low"), F.max("page").alias("high"), F.count(F.lit(1)).alias("n"))
        .where(frequent))
    site_wide = _site_wide(pages, array, min_run)
    names = [F.col("id").alias(id_col), F.col("url").alias(url_col), "text",
             F.length("text").cast("long").alias("n_chars")]
    if site_wide is None:
        pages = pages.withColumn("site", F.lit(False))
    else:
        found = sized_broadcast(site_wide.select("number").distinct(), SMALL).withColumn("site", F.lit(True))
        pages = pages.join(found, "number", "left").withColumn("site", F.col("site").isNotNull())
    by_markup = _by_markup(pages)
    if site_wide is None and array.where("entry is null").isEmpty():  # nothing is left to the array
        return by_markup.where("text is not null").select(names)
    unclear = stored(by_markup.where("text is null").select(
        "id", "url", "host", "html", "site", F.monotonically_increasing_id().alias("row")))
    repeated = array.where((F.col("place") == _OUTSIDE) & F.col("entry").isNotNull()).select("entry")
    if site_wide is not None:
        repeated = repeated.union(site_wide.select("entry"))
    covered = (_suffixes(unclear, min_run, site_wide is not None).join(repeated, "entry")
               .groupBy("row").agg(F.collect_set("at").alias("covered")))  # one page's positions

    def prepare():
        def compute(htmls, places):
            return ([_unmarked(blocks(h or "", main=OPEN), set(p or ()), min_run)
                     for h, p in zip(htmls, places)],)
        return compute

    rest = add_columns(unclear.join(covered, "row", "left"), ["html", "covered"], "text string",
                       prepare, drop=["html", "covered"])
    return by_markup.where("text is not null").select("id", "url", "text").union(
        rest.select("id", "url", "text")).select(names)


def _by_markup(pages: DataFrame) -> DataFrame:
    """``pages`` with ``text``, null where a host's page needs the array: for unclear
    blocks, or an article of a host with site-wide stretches."""
    def prepare():
        def compute(hosts, htmls, sites):
            texts = []
            for host, html, site in zip(hosts, htmls, sites):
                page = blocks(html or "", main=OPEN)
                unclear = host is not None and any(
                    zone in UNCLEAR or site and zone == MAIN for zone, _ in page)
                texts.append(None if unclear else " ".join(t for zone, t in page if zone != CHROME))
            return (texts,)
        return compute

    return add_columns(pages, ["host", "html", "site"], "text string", prepare)


def _suffixes(unclear: DataFrame, min_run: int, articles: bool) -> DataFrame:
    """(row, at, entry) of every suffix of the stored pages; with ``articles`` those of
    the articles of ``site`` hosts too, counted down from -1."""
    def run(batches):
        for batch in slices(batches):
            rows, places, entries = [], [], []
            for row, host, html, site in zip(
                    *(batch.column(c).to_pylist() for c in ("row", "host", "html", "site"))):
                page = blocks(html or "", main=OPEN)
                own = _entries(host, _stream(page)[1], min_run)
                rows += [row] * len(own)
                places += range(len(own))
                entries += own.tolist()
                if articles and site:
                    own, _ = _article(host, page, min_run)
                    rows += [row] * len(own)
                    places += range(-1, -1 - len(own), -1)
                    entries += own.tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), pa.array(places, pa.int32()),
                 pa.array(entries, pa.int64())], ["row", "at", "entry"])

    return unclear.select("row", "host", "html", "site").mapInArrow(run, T._parse_datatype_string(
        "row long, at int, entry long"))
