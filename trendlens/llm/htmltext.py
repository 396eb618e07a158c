"""Main text of web pages, with site templates removed.

Elements of a page are hashed with all they contain.  Spark counts, per host,
on how many different pages each hash occurs; an element that recurs on many
of them (menus, notices, share bars that a site repeats) is deleted from
every page of the host before its text is taken.  Elements whose tag, class
or role names them as something other than content go as well.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlens.llm.common import fresh, python_workers, written

# A subtree is a template if it is on at least so many different pages of its
# host and on at least this share of them,
MIN_PAGES = 5
MIN_SHARE = 0.5
# or on so many pages and this small share.
MANY_PAGES = 50
SMALL_SHARE = 0.01

# Fixed values of HTML: elements by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template svg annotation annotation-xml".split())
SKIP = RAW | frozenset("head nav footer aside form button select option datalist dialog object audio video canvas "
                       "map applet menu".split())
BLOCK = frozenset("address article blockquote body caption center dd details div dl dt fieldset figcaption figure "
                  "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main nav ol p pre section summary "
                  "table tbody td tfoot th thead tr ul aside dialog menu search".split())
# Start tags that end an open element of these names (end tags left out).
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"},
          "tfoot": {"tbody", "tr", "td", "th"}}
# An implied end does not reach beyond these.
SCOPE = frozenset("table td th ul ol dl article section div main body html blockquote aside nav header footer "
                  "form".split())
ENDS_P = BLOCK - {"tr", "td", "th", "tbody", "thead", "tfoot", "caption", "body", "html"}
# The page itself is no template.
ROOTS = frozenset("article main body html".split())
# Paragraph-level elements hold the words of the article: MANY_PAGES and
# SMALL_SHARE alone make them templates.  Headings, cells, terms and inline
# elements recur in articles of their own accord ("References", "yes"): alone
# they go only from MANY_PAGES and MIN_SHARE on.
PLAIN = frozenset("p blockquote pre li dd tr figcaption caption table tbody thead tfoot".split())
SMALL = frozenset("h1 h2 h3 h4 h5 h6 td th dt".split())

# Words that, as a whole token of class, id or role, name something other than
# the article; and those that may name a part of it inside article or main.
BOILERPLATE = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar nav navbar "
    "navigation menu breadcrumb breadcrumbs footer cookie cookies consent gdpr notice notices popup modal overlay "
    "newsletter subscribe signup share sharing social related recommended comment comments disqus replies reply "
    "respond widget toolbar pagination pager complementary contentinfo search dialog alert login hidden".split())
AMBIGUOUS = frozenset("alert notice notices search dialog social promotion navigation".split())
CLEAR = BOILERPLATE - AMBIGUOUS
SITE_HEADER = frozenset("header masthead topbar".split())
# Compounds count if all their parts are words of the lists above and of this one.
JOINED = frozenset(
    "site page global top bottom left right main primary secondary mobile desktop bar box block container wrapper wrap "
    "inner outer list links link button buttons icon icons section area slot unit group item items tools post posts "
    "article articles stories content form title message".split())
JOINED_HEADER = frozenset("site page global top main bar container wrapper wrap inner".split())
# Slugs of headings name what the article is about, not what the element is.
NO_IDS = frozenset("p h1 h2 h3 h4 h5 h6".split())
# Articles, or main, are the page's text if they hold this share of it.
ROOT_SHARE = 0.5

_OPEN = re.compile(r"<(?:(!--)|(/?)([A-Za-z][^\s/>]*)|([!?/]))")
_ATTRS = re.compile(r"""([^\s=>"'/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")
_NAMING = re.compile("class|id|role|hidden", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+(?:x[0-9]+)?|[^\W\dA-Za-z_]+")
_TAG_END = re.compile(r"""[>"']""")


def _tag_end(html: str, at: int) -> int:
    """Place after the ``>`` that ends a tag; quoted values may hold one."""
    while m := _TAG_END.search(html, at):
        if m[0] == ">":
            return m.end()
        before = html[at:m.start()].rstrip()
        close = html.find(m[0], m.end()) if before.endswith("=") else m.start()
        if close < 0:  # a quote that is never closed does not take the page with it
            return html.find(">", m.end()) + 1 or len(html)
        at = close + 1
    return len(html)


def _token_names(token: str, words: frozenset, joined: frozenset) -> bool:
    """Whether a token is one of ``words``, or a compound of them and of
    ``joined`` words and numbers (``share-bar``, ``adSlot-2``)."""
    if token.lower() in words:
        return True
    parts = [p.lower() for p in _PARTS.findall(token)]
    return any(p in words for p in parts) and all(p in words or p in joined or p[0].isdigit() for p in parts)


def _named(tag: str, attrs: str, inside: bool) -> bool:
    """Whether class, id or role name an element as something but content.

    ``inside`` article or main words that may be content don't count, nor do
    ids of sections; ids of headings and paragraphs count nowhere.
    """
    if len(attrs) < 3 or not _NAMING.search(attrs):
        return False
    words = CLEAR if inside else BOILERPLATE
    for name, a, b, c in _ATTRS.findall(attrs):
        name = name.lower()
        if name == "hidden":
            return True
        if name not in ("class", "id", "role") or name == "id" and (tag in NO_IDS or inside and tag == "section"):
            continue
        for token in (a or b or c).split():
            if _token_names(token, words, JOINED) or not inside and _token_names(token, SITE_HEADER, JOINED_HEADER):
                return True
    return False


def _joined(pieces: list[tuple[int, str]]) -> str:
    return " ".join("".join([t for _, t in pieces]).split())


class Page:
    """Blocks of text of a page, each with the elements it stands in.

    ``elements`` holds ``[tag, start, end, parent, skipped]`` in page order
    and ``blocks`` ``(element, text, pieces)``, a piece being the innermost
    element of a part of the text and that part.
    """

    def __init__(self, html: str):
        self.html = html
        self.elements: list[list] = []
        self.blocks: list[tuple[int, str, list[tuple[int, str]]]] = []
        self._read()

    def _read(self) -> None:
        html, stack, runs, elements = self.html, [], [], self.elements
        holder = -1  # element of the block being read

        def flush() -> None:
            nonlocal holder
            if runs:
                text = _joined(runs)
                if text:
                    self.blocks.append((holder, text, runs[:]))
                runs.clear()
            holder = stack[-1] if stack else -1

        def close(upto: int, end: int) -> None:
            while len(stack) > upto:
                k = stack[-1]
                elements[k][2] = end
                if elements[k][0] in BLOCK:
                    flush()
                stack.pop()
                if elements[k][0] in BLOCK:
                    flush()

        def imply_end(names: set, at: int) -> None:
            for depth in range(len(stack) - 1, -1, -1):
                tag = elements[stack[depth]][0]
                if tag in names:
                    close(depth, at)
                    return
                if tag in SCOPE:
                    return

        def text(piece: str) -> None:
            if piece and not (stack and elements[stack[-1]][4]):
                runs.append((stack[-1] if stack else -1, unescape(piece) if "&" in piece else piece))

        at = 0
        while m := _OPEN.search(html, at):
            text(html[at:m.start()])
            start = m.start()
            if m[1]:
                end = html.find("-->", start + 4)
                at = len(html) if end < 0 else end + 3
                continue
            at = _tag_end(html, m.end())
            if m[4]:
                continue
            tag = m[3].lower()
            if m[2]:
                for depth in range(len(stack) - 1, -1, -1):
                    if elements[stack[depth]][0] == tag:
                        close(depth, at)
                        break
                continue
            if tag in VOID:
                if tag == "hr":
                    flush()
                elif tag == "br":
                    runs.append((stack[-1] if stack else -1, " "))
                continue
            if tag in CLOSES:
                imply_end(CLOSES[tag], start)
            if tag in ENDS_P:
                imply_end({"p"}, start)
            parent = stack[-1] if stack else -1
            within = parent >= 0 and elements[parent][5]
            skipped = (parent >= 0 and elements[parent][4] or tag in SKIP or tag == "header" and not within
                       or tag not in ("html", "body", "article", "main")
                       and _named(tag, html[m.end():at], within))
            inside = within or tag in ("article", "main")
            if tag in BLOCK:
                flush()
            elements.append([tag, start, len(html), parent, skipped, inside])
            if tag in RAW and not html[at - 2:at] == "/>":
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(html, at)
                at = _tag_end(html, end.end()) if end else len(html)
                elements[-1][2] = at
                continue
            stack.append(len(elements) - 1)
            if tag in BLOCK:
                flush()
        text(html[at:])
        close(0, len(html))
        flush()

    def content(self) -> list[tuple[int, str, list[tuple[int, str]]]]:
        """Blocks of the article, without those in skipped elements: those in
        ``main`` if they hold ``ROOT_SHARE`` of the text, else all; of these
        the ones in ``article`` elements if they again hold that share."""
        kept = [b for b in self.blocks if b[0] < 0 or not self.elements[b[0]][4]]
        for root in ("main", "article"):
            inside = [b for b in kept if self._within(b[0], root)]
            if inside and sum(len(b[1]) for b in inside) >= ROOT_SHARE * sum(len(b[1]) for b in kept):
                kept = inside
        return kept

    def _within(self, k: int, tag: str) -> bool:
        while k >= 0:
            if self.elements[k][0] == tag:
                return True
            k = self.elements[k][3]
        return False

    def subtree_hash(self, k: int) -> int:
        _, start, end, *_ = self.elements[k]
        return xxhash.xxh64_intdigest(self.html[start:end].encode("utf-8", "surrogatepass")) - (1 << 63)

    def candidates(self) -> dict[int, int]:
        """``{element: hash}`` of the subtrees with content that may be
        templates: all but the page itself and inline elements that stand in
        running text, beside loose words of an element around them."""
        out: dict[int, int] = {}
        for holder, _, pieces in self.content():
            loose = {k for k, t in pieces if t and not t.isspace()}
            inline: set[int] = set()
            for k in loose:
                path = []
                while k >= 0 and k != holder:
                    path.append(k)
                    k = self.elements[k][3]
                if k != holder or holder in loose:
                    continue
                for e in reversed(path):  # from the outside in
                    inline.add(e)
                    if e in loose:
                        break
            for e in inline:
                if e not in out:
                    out[e] = self.subtree_hash(e)
            k = holder
            while k >= 0 and k not in out:
                if self.elements[k][0] not in ROOTS:
                    out[k] = self.subtree_hash(k)
                k = self.elements[k][3]
        return out

    def kinds(self) -> set[tuple[int, int]]:
        """``(hash, kind)`` of the candidates: 0 for elements around content,
        1 for paragraph-level ones, 2 for headings, cells and inline ones."""
        tag = [e[0] for e in self.elements]
        return {(h, 1 if tag[k] in PLAIN else 2 if tag[k] in SMALL or tag[k] not in BLOCK else 0)
                for k, h in self.candidates().items()}

    def text(self, templates: frozenset[int] | set[int] = frozenset()) -> str:
        content = self.content()
        gone = {k for k, h in self.candidates().items() if h in templates} if templates else set()
        if not gone:
            return "\n\n".join(t for _, t, _ in content)

        def kept(k: int) -> bool:
            while k >= 0:
                if k in gone:
                    return False
                k = self.elements[k][3]
            return True

        texts = [_joined([p for p in pieces if kept(p[0])]) for k, _, pieces in content if kept(k)]
        return "\n\n".join(t for t in texts if t)


def extract_text(html: str | None, templates: set[int] | frozenset[int] = frozenset()) -> str:
    return Page(html or "").text(templates)


def host_col(url: Column) -> Column:
    """Host of a URL, A-Z lowered; empty without ``://``."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def site_templates(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """``(host, templates)``: hashes of the subtrees that recur on many
    different pages of a host.

    A subtree around content is a template from ``min_pages`` pages and
    ``min_share`` of them on, or from ``MANY_PAGES`` and ``SMALL_SHARE`` on;
    the latter alone hold for paragraph-level elements, ``MANY_PAGES`` and
    ``min_share`` for headings, cells and inline elements.  Pages of one host
    with the same content count once, so copies of an article never make it a
    template.  Counts are summed per task first; as a template is on a
    hundredth of its host's pages, a host has at most a hundred times as many
    as a page has elements, whatever its size.
    """
    python_workers(pages.sparkSession)

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                page = Page(html or "")
                content = "\n\n".join(t for _, t, _ in page.content()).encode("utf-8", "surrogatepass")
                pairs = sorted(page.kinds())
                # The entry without a hash counts the different pages of the host.
                rows.append((host, xxhash.xxh64_intdigest(content) - (1 << 63), [*(h for h, _ in pairs), None],
                             [*(k for _, k in pairs), None]))
            cols = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.list_(pa.int64())),
                 pa.array(cols[3], pa.list_(pa.int32()))], ["host", "content", "hash", "kind"])

    own = pages.select(host_col(F.col("url")).alias("host"), "html").mapInArrow(
        hashes, "host string, content long, hash array<long>, kind array<int>")
    seen = written(own.select("host", "content", F.explode(F.arrays_zip("hash", "kind")).alias("e"))
                   .select("host", "content", "e.*").distinct(), "html-subtrees")
    counts = written(seen.groupBy("host", "hash", "kind").agg(F.count("*").alias("n")), "html-counts")
    hosts = counts.filter("hash IS NULL").select("host", F.col("n").alias("pages"))
    n, pages_n, kind = F.col("n"), F.col("pages"), F.col("kind")
    often = (n >= MANY_PAGES) & (n >= pages_n * SMALL_SHARE)
    half = n >= pages_n * min_share
    many = (counts.filter(f"hash IS NOT NULL AND n >= {int(min(min_pages, MANY_PAGES))}").join(hosts, "host")
            .filter(((kind == 0) & (half & (n >= min_pages) | often)) | ((kind == 1) & often) | (often & half)))
    return many.groupBy("host").agg(F.sort_array(F.collect_list("hash")).alias("templates"))


def extract_pages(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """``pages`` with ``main_text``: blocks of the article joined by two line
    feeds, white space inside a block turned into one space.

    A NULL or empty html has the empty text; a NULL url has the empty host;
    repeated ids and rows are extracted one by one; other columns are
    returned as they came; an empty table gives no rows.
    """
    python_workers(pages.sparkSession)
    templates = written(site_templates(pages, min_pages, min_share), "html-templates")
    host, list_col, out = fresh(pages, "host"), fresh(pages, "templates"), fresh(pages, "main_text")

    @F.pandas_udf("string")
    def main_text(html: pd.Series, gone: pd.Series) -> pd.Series:
        return pd.Series([extract_text(h, frozenset() if g is None else frozenset(g.tolist()))
                          for h, g in zip(html, gone)], dtype=object)

    return (pages.withColumn(host, host_col(F.col("url")))
            .join(templates.select(F.col("host").alias(host), F.col("templates").alias(list_col)), host, "left")
            .select(*pages.columns, main_text(F.col("html"), F.col(list_col)).alias(out)))
