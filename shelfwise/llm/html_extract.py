"""Main text of web pages by a maximum-scoring subsequence.

A page is read once into a sequence of tags and runs of words. Words score
positive by the block they stand in, tags negative by their name; one linear
scan finds the contiguous region with the largest sum, and the text blocks of
that region are the result. A page with ``article`` or ``main`` elements has a
label of its own: words outside score against, and the region is widened to
hold these elements whole, however many tags they hold.

An element whose name, class, id or role tells that it is no article text (a
menu, footer, sidebar, notice, advert, form, reader's comment) counts as one tag
and is left out whole, so one inside the article does not cut it in two. What
tells so is weighed, too: an element goes if the weights of its hints sum up
to less than zero. An article itself never goes.

The weights are log-odds of a token inside against outside the article, counted
over all labelled pages: words by block, tags by name, and hints by the words
below them, those of an article they enclose against all others. (A hint inside
an article says nothing about itself and is not counted.) Word weights are kept
above zero and tag weights below. A hint that no labelled page has counts as
seen outside, ``PRIOR``; so without labelled pages the fixed lists decide, a
word weighs 1 and a tag next to nothing. Ids that may as well name a topic
(``TOPICS``) have no such prior.

Scale: two passes over the pages, row by row. Training emits some sixty
counts a task; the weights, as many, go along with the code.

Nulls and edge cases: null or empty html, and a page without text, give an
empty text. Comments, tags and character references that the page's end cuts
off are dropped or read as far as they go, as browsers do. Repeated rows and
ids are rows of their own; other columns pass through, but one named like an
output column is replaced. An empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import col, ship_code, without

# HTML's elements by their part in a page.
RAW = {"script", "style", "title", "textarea", "noscript", "template", "iframe", "xmp", "noembed", "noframes"}
SKIPPED = {"head", "nav", "footer", "aside", "form", "svg", "button", "select", "dialog", "menu", "object", "canvas",
           "audio", "video", "datalist", "fieldset", "option"}
SKIPPED_BLOCKS = {"head", "nav", "footer", "aside", "form", "dialog", "menu", "fieldset"}
BLOCKS = {"address", "article", "blockquote", "body", "caption", "center", "dd", "details", "dir", "div", "dl", "dt",
          "figcaption", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "li", "main",
          "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
LEAVES = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "td", "th", "pre", "blockquote", "figcaption",
          "caption", "summary"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "b", "br", "em", "i", "img", "span", "strong", "sub", "sup", "u", "code"}
ARTICLE = {"article", "main"}
# What marks no article text, as a whole class, id or role, or with companions in a compound.
HINTS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "banner", "sponsor", "sponsored",
         "promo", "promotion", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "alert", "popup", "modal",
         "overlay", "newsletter", "subscribe", "subscription", "signup", "login", "nav", "navbar", "navigation", "menu",
         "breadcrumb", "breadcrumbs", "sidebar", "widget", "widgets", "related", "recommended", "share", "sharing",
         "social", "footer", "masthead", "topbar", "toolbar", "pagination", "pager", "search", "comment", "comments",
         "commentlist", "disqus", "replies", "respond", "contentinfo", "complementary", "dialog", "form"}
HEADER_HINTS = {"header", "headingbar"}
COMPANIONS = {"area", "bar", "block", "body", "bottom", "box", "button", "buttons", "container", "field", "global", "header",
              "holder", "icons", "inner", "items", "left", "links", "list", "main", "message", "outer", "page", "panel",
              "posts", "primary", "right", "secondary", "section", "site", "slot", "thread", "top", "unit", "wrap",
              "wrapper"}
COMMENTS = {"comment", "comments", "commentlist", "disqus", "replies", "respond"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
TOPICS = {"search", "related", "recommended", "social", "share", "sharing", "subscription", "widget", "widgets", "form"}

LEAST = 0.05     # smallest size of a weight
WORD = 1.0       # a word in a block that no labelled page has
OUTSIDE = 1.0    # what a word costs beside the article of a page that has one
TAG = 1.0        # largest cost of a tag: a few of them never outweigh a title
SEEN = 20        # words that a hint of the lists counts as seen outside beforehand
PRIOR = float(np.log(1 / (1 + SEEN)))

_TOKEN = re.compile(
    r"<!--(?:.*?(?:-->|--!>)|.*)"                                   # comment, or cut off
    r"|<[!?][^>]*(?:>|$)"                                           # declaration
    r"|<(/?)([a-zA-Z][^\s/>]*)"                                     # tag: name, attributes, end
    r"((?:[\s/]+|[^\s/>][^\s/>=]*(?:\s*=\s*(?:\"[^\"]*(?:\"|$)|'[^']*(?:'|$)|[^\s>\"'][^\s>]*)?)?)*+)(>|$)", re.S)
_SCRIPT = re.compile(r"<!--|-->|<(/?)script(?=[\s/>])", re.I)
_ATTRIBUTE = re.compile(r"([^\s/>][^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>\"'][^\s>]*))?)?")
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+|[^\W\d_]+")


def _marks(token: str, hints: set[str]) -> bool:
    """Whether a class, id or role is a hint, alone or in a compound of hints and companions."""
    whole = token.lower().replace("-", "").replace("_", "")
    parts = {p.lower() for p in _NAME_PART.findall(token)}
    return whole in hints or bool(parts & hints) and all(p in hints or p in COMPANIONS or p.isdigit() for p in parts)


def _hints(name: str, attributes: str, in_article: bool) -> set[str]:
    """What the name, class, id and role of an element say against it: kinds of hints (``e:``
    for elements, ``c:`` for words, ``i:`` for an id that may be a topic).

    Inside an article ids name its parts: only those of comments count there, and none of a heading."""
    if name in ("html", "body", "main"):
        return set()
    found = {f"e:{name}"} if name in SKIPPED or name == "header" and not in_article else set()
    for m in _ATTRIBUTE.finditer(attributes):
        kind = m[1].lower()
        if kind not in ("class", "id", "role") or kind == "id" and in_article and name in HEADINGS:
            continue
        for token in html.unescape(m[2] or m[3] or m[4] or "").split():
            comment = _marks(token, COMMENTS)
            if comment or not (kind == "id" and in_article) and _marks(token, HINTS if in_article else HINTS | HEADER_HINTS):
                word = token.lower()
                if kind == "id" and word in TOPICS:
                    found.add(f"i:{word}")
                else:
                    parts = {p.lower() for p in _NAME_PART.findall(token)}
                    found.update(f"c:{p}" for p in parts & (HINTS | HEADER_HINTS) or {"compound"})
    return found


def _goes(kinds: set[str], weights: dict[str, float]) -> bool:
    return sum(weights.get(k, 0.0 if k[0] == "i" else PRIOR) for k in kinds) < 0


def _raw_end(page: str, at: int, name: str) -> int:
    """Where the end tag of an element without markup ends, whose content begins at ``at``.

    Only a script may speak of its own tags: in ``<!-- <script> ... </script> -->``."""
    if name != "script":
        m = re.compile(rf"</{name}(?=[\s/>])", re.I).search(page, at)
    else:
        inside = 0               # 1: after <!--, 2: after <script in there
        while m := _SCRIPT.search(page, at):
            at = m.end()
            if m[0] == "<!--":
                inside, at = inside or 1, at - 2
            elif m[0] == "-->":
                inside = 0
            elif not m[1]:
                inside = 2 if inside else 0
            elif inside < 2:
                break
            else:
                inside = 1
    return _TOKEN.match(page, m.start()).end() if m else len(page)


def tokens(page: str, weights: dict[str, float] | None) -> Iterator[tuple[str, str, bool, frozenset[str]]]:
    """(kind, text, in the article, hints around) of a page, in order. Elements whose hints weigh
    against them are one ``t:skipped``. Without ``weights`` nothing is left out, and hints around
    are those of open elements; inside an article those that enclose it.

    Kind is ``w:`` and the block that text stands in, or ``t:`` and the tag;
    ``|`` comes before each kind of a tag that ends a block."""
    at = 0
    skip: list[str] = []         # open elements from the outermost one on that goes (or, to count, has hints)
    seen: list[set[str]] = []    # the hints of each
    around: frozenset[str] = frozenset()
    article, had_article = 0, False  # open article elements; whether there was one
    link, leaf, leaf_out = 0, "other", False
    while True:
        m = _TOKEN.search(page, at)
        text = page[at:m.start()] if m else page[at:]
        if text and not text.isspace() and (weights is None or not skip and not leaf_out):
            inner = frozenset().union(*seen) if skip else around
            yield "w:" + ("a" if link else leaf), text, article > 0 and not skip, inner
        if m is None:
            return
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        closing = bool(m[1])
        if m[4] == "":           # the page ends inside a tag
            return
        if skip:
            block = name in BLOCKS
            if closing:
                if name in skip:
                    while skip.pop() != name:
                        seen.pop()
                    seen.pop()
                elif name in ("body", "html"):
                    skip, seen = [], []
            elif name in ARTICLE and not had_article and not set(skip) & {"article", "nav", "footer", "aside", "form"} \
                    and not any(k[2:] in COMMENTS for kinds in [*seen, _hints(name, m[3], True)] for k in kinds):
                around = frozenset().union(*seen)
                skip, seen = [], []   # an element left open does not swallow the article
                article, had_article = article + 1, True
                link, leaf = 0, "other"
                yield "|t:" + name, "", True, around
                continue
            elif name in RAW and not m[3].endswith("/"):
                at = _raw_end(page, at, name)
            elif name == "body" and skip[0] == "head":
                skip, seen = [], []
            elif name not in VOID and not m[3].endswith("/"):
                skip.append(name)
                seen.append(_hints(name, m[3], article > 0) if weights is None else set())
            if weights is None:
                leaf = name if name in LEAVES and not closing else "other" if block else leaf
                link = (0 if closing else 1) if name == "a" else 0 if block else link
                yield ("|" if block else "") + "t:" + ("/" if closing else "") + (
                    name if block or name in INLINE else "other"), "", False, frozenset()
            continue
        if not closing and name in RAW:
            at = _raw_end(page, at, name) if not m[3].endswith("/") else at
            continue
        block = name in BLOCKS
        if block:
            leaf_out = False
        if not closing and name not in VOID:
            hints = set() if name == "article" and not article else _hints(name, m[3], article > 0)
            if hints and (weights is None or _goes(hints, weights)) and not m[3].endswith("/"):
                ends = block or name in SKIPPED_BLOCKS
                if name in LEAVES and name != "li" and weights is not None:
                    leaf, leaf_out = name, True     # its end tag may be left out: until the next block
                elif name not in LEAVES or name == "li":
                    skip, seen = [name], [hints]
                yield ("|" if ends else "") + "t:skipped", "", article > 0, frozenset()
                if skip or leaf_out:
                    continue
        if name in ARTICLE:
            article = max(0, article - 1) if closing else article + 1
            had_article = True
            around = around if article else frozenset()
        if name == "a":
            link = 0 if closing else 1
        if block:
            link = 0
            leaf = name if name in LEAVES and not closing else "other"
        known = name if block or name in INLINE else "other"
        yield ("|" if block else "") + "t:" + ("/" if closing else "") + known, "", article > 0, frozenset()


def _clean(parts: list[str]) -> str:
    return " ".join(html.unescape("".join(parts)).split())


def best_region(scores: list[float]) -> tuple[int, int]:
    """The bounds of the contiguous run with the largest sum (the first such; empty if none is over zero)."""
    best, span, total, start = 0.0, (0, 0), 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, span = total, (start, i + 1)
    return span


def _score(kind: str, text: str, beside: bool, weights: dict[str, float]) -> float:
    if kind.startswith("w:"):
        return len(text.split()) * (-OUTSIDE if beside else max(LEAST, weights.get(kind, WORD)))
    return max(-TAG, min(-LEAST, weights.get(kind.lstrip("|"), -LEAST)))


def extract(page: str | None, weights: dict[str, float]) -> str:
    """The main text of one page: its blocks, joined by line breaks."""
    seq = list(tokens(page or "", weights))
    marked = [i for i, (_, _, inside, _) in enumerate(seq) if inside]
    first, last = best_region([_score(kind, text, bool(marked) and not inside, weights) for kind, text, inside, _ in seq])
    if marked:
        first, last = min(first, marked[0]) if last else marked[0], max(last, marked[-1] + 1)
    blocks: list[list[str]] = [[]]
    for kind, text, inside, _ in seq[first:last]:
        if kind.startswith("w:"):
            if inside or not marked:
                blocks[-1].append(text)
        elif kind.startswith("|"):
            blocks.append([])
        elif kind.endswith(("t:br", "t:img")):
            blocks[-1].append(" ")
    return "\n".join(filter(None, map(_clean, blocks)))


def fit(pages: DataFrame, html_col: str = "html") -> dict[str, float]:
    """Log-odds of each kind of token, over all labelled pages."""
    ship_code(pages.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside: Counter = Counter()
        outside: Counter = Counter()
        for batch in batches:
            for page in batch.column(0):
                seq = list(tokens(page.as_py() or "", None))
                if not any(x for _, _, x, _ in seq):
                    continue
                for kind, text, x, around in seq:
                    n = len(text.split()) if text else 1
                    (inside if x else outside)[kind.lstrip("|")] += n
                    for hint in around if text else ():
                        (inside if x else outside)[hint] += n
        kinds = sorted({*inside, *outside})
        yield pa.RecordBatch.from_arrays(
            [pa.array(kinds, pa.string()), pa.array([inside[k] for k in kinds], pa.int64()),
             pa.array([outside[k] for k in kinds], pa.int64())], names=["kind", "inside", "outside"])

    got = (pages.select(col(html_col).cast("string").alias("html"))
           .mapInArrow(count, "kind string, inside long, outside long")
           .groupBy("kind").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
           .collect())  # one row for each kind of token, which the element lists bound
    plain = [r for r in got if r["kind"][0] in "wt"]
    all_in = sum(r["inside"] for r in plain) + len(plain)
    all_out = sum(r["outside"] for r in plain) + len(plain)
    shift = {"w": np.log(all_out / all_in), "t": np.log(all_out / all_in), "c": 0.0, "e": 0.0, "i": 0.0} if plain else {}
    before = {"w": 1, "t": 1, "c": 1 + SEEN, "e": 1 + SEEN, "i": 1}
    return {r["kind"]: float(np.log((r["inside"] + 1) / (r["outside"] + before[r["kind"][0]])) + shift[r["kind"][0]])
            for r in got}


def main_text(pages: DataFrame, weights: dict[str, float], html_col: str = "html",
              text_col: str = "text") -> DataFrame:
    """``pages`` with the main text of each page."""
    ship_code(pages.sparkSession)
    pages = without(pages, [text_col]) if text_col != html_col else pages
    at = pages.columns.index(html_col)
    schema = T.StructType([*pages.schema.fields, T.StructField(text_col, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = pa.array([extract(p.as_py(), weights) for p in batch.column(at)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, out], names=schema.names)

    return pages.mapInArrow(run, schema)
