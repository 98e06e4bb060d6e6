"""Main text of web pages: flat text blocks classified by a decision tree.

A page is cut into flat blocks at block-level tags.  A block is described by its number of words and
its link density (share of words inside links), those of the block before and after it, and what
encloses it: an article, a part that names itself as menu, header, footer, sidebar, form, notice,
advert or comments, and whether it is a heading.  A decision tree, grown by Gini impurity on the
small labelled table below, says which blocks are main text.  Where neither an article nor a telling name
encloses a block, its words, its links and its neighbours decide: link lists, cookie bars and lines
of small print between links go; captions, short lines between paragraphs and last sentences stay.

A name tells something about a part if one of its words does ("site-nav"), but not if it tells how the page is
laid out ("with-sidebar", "search-page"); inside an article its last word has to be telling or
a word for a part ("share-buttons", not "social-history").  What an element around the page's first article or
main element says is forgotten there, unless it is meant for comments, related items or adverts.

Scripts, styles, comments, templates and other elements without prose never become text.  Kept blocks
have character references decoded and white space folded to one space, and are joined in page order
by an empty line; nothing else is dropped or cut.

Defined cases: null or empty html gives the empty text; text without any tag is one block; unclosed
tags, comments and scripts end with the page; repeated rows give repeated results; an empty table
gives an empty table; result columns replace input columns of the same name.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recengine.llm.common import with_results

# Element names of HTML and MathML, by what they mean for cutting.
INLINE = frozenset("a abbr acronym b bdi bdo big button cite code data del dfn em font i ins kbd label mark q rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var wbr img nobr math mfrac mi mn mo mover mpadded mroot "
                   "mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics annotation "
                   "annotation-xml".split())
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("script style noscript template textarea select svg iframe object canvas audio video head title "
                    "annotation annotation-xml".split())
RAW = frozenset("script style textarea title iframe".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ARTICLE = frozenset("article main".split())
ASIDE = frozenset("nav header footer aside form menu dialog".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu".split())
CLOSES = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "option": ("option",)}
# Words that elements outside the article use in class or id.
HINTS = frozenset("ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments "
                  "consent cookie cookies copyright disclaimer disqus donate footer gdpr header login masthead menu modal nav "
                  "navbar navigation newsletter notice notices notification overlay pager pagination paywall popup promo "
                  "promoted promotion related replies reply search share sharing sidebar signup skip social sponsor sponsored "
                  "subscribe subscription toolbar topbar widget".split())
# Words of names that say how a page is laid out, first or last in the name.
LAYOUT_FIRST = frozenset("with has no without is show hide".split())
LAYOUT_LAST = frozenset("page layout template theme site app root".split())
# Last words of names of parts, after a telling word.
PARTS = frozenset("area bar block box button buttons container content form group icon icons inner item items link links list "
                  "panel post posts row section slot text title unit wrap wrapper".split())
#: Telling words of parts that keep their meaning around an article.
FIRM = frozenset("ad ads adv advert adverts advertisement advertising comment comments disqus promo promoted promotion related "
                 "replies reply sponsor sponsored".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "article", "aside", "heading")
# The labelled table: one block a line; FEATURES in order, then 1 for main text.  Counts of -1: no such neighbour.
LABELLED = """
4 1.00 -1 0 3 1.00 0 1 0 0
1 1.00 4 1.00 1 1.00 0 1 0 0
1 1.00 1 1.00 9 0.00 0 1 0 0
9 0.00 1 1.00 14 0.00 0 1 0 0
14 0.00 9 0.00 60 0.00 1 0 1 1
60 0.00 14 0.00 45 0.00 1 0 0 1
45 0.02 60 0.00 3 0.00 1 0 0 1
3 0.00 45 0.02 80 0.10 1 0 0 1
80 0.10 3 0.00 12 0.00 1 0 0 1
12 0.00 80 0.10 -1 0 0 1 0 0
1 0.00 30 0.00 25 0.00 1 0 0 1
2 0.50 30 0.00 25 0.00 1 0 0 1
5 1.00 40 0.00 38 0.00 1 0 0 1
30 0.00 25 0.00 5 1.00 0 1 0 0
120 0.00 3 1.00 90 0.00 0 1 0 0
90 0.05 120 0.00 5 0.00 0 1 0 0
6 0.00 90 0.05 50 0.00 0 1 1 0
50 0.00 6 0.00 -1 0 0 1 0 0
7 0.00 -1 0 70 0.00 0 0 1 1
70 0.00 7 0.00 65 0.03 0 0 0 1
65 0.03 70 0.00 40 0.00 0 0 0 1
40 0.00 65 0.03 20 0.10 0 0 0 1
20 0.10 40 0.00 5 0.00 0 0 0 1
18 0.00 55 0.00 40 0.00 0 0 0 1
5 0.00 20 0.10 33 0.00 0 0 0 1
9 0.00 44 0.00 30 0.00 0 0 1 1
8 0.00 2 1.00 52 0.00 0 0 1 1
52 0.00 8 0.00 3 1.00 0 0 0 1
3 1.00 52 0.00 4 1.00 0 0 0 0
4 1.00 3 1.00 2 1.00 0 0 0 0
2 1.00 4 1.00 -1 0 0 0 0 0
6 0.83 1 1.00 2 1.00 0 0 0 0
12 0.90 2 1.00 4 1.00 0 0 0 0
25 0.70 4 1.00 3 1.00 0 0 0 0
3 0.67 12 0.90 5 1.00 0 0 0 0
35 0.15 28 0.00 -1 0 0 0 0 1
-1 0 -1 0 -1 0 0 1 0 0
10 0.00 -1 0 -1 0 0 0 0 1
1 0.00 -1 0 -1 0 0 0 0 1
8 0.00 -1 0 -1 0 1 0 1 1
2 0.00 -1 0 15 0.00 1 0 0 1
3 0.00 12 0.00 -1 0 1 0 0 1
4 1.00 22 0.00 -1 0 1 0 0 1
16 0.40 10 0.00 30 0.00 0 1 0 0
24 1.00 -1 0 -1 0 1 0 1 1
3 0.00 4 1.00 5 0.00 0 1 1 0
11 0.20 60 0.00 48 0.00 0 0 0 1
4 0.00 30 0.00 3 1.00 1 0 0 1
1 0.00 9 0.00 1 1.00 1 0 0 1
8 0.00 -1 0 1 1.00 1 0 1 1
10 0.00 3 1.00 1 1.00 1 0 0 1
2 0.00 1 1.00 1 1.00 1 0 0 1
3 1.00 1 1.00 4 1.00 1 0 0 1
2 1.00 -1 0 1 1.00 0 0 0 0
2 1.00 3 1.00 8 0.00 0 0 0 0
1 1.00 2 1.00 46 0.00 0 0 0 0
14 0.07 -1 0 2 1.00 0 0 0 0
18 0.00 -1 0 1 1.00 0 0 0 0
12 0.10 -1 0 3 1.00 0 0 0 0
5 0.00 -1 0 2 1.00 0 0 0 0
3 0.00 -1 0 1 1.00 0 0 1 0
9 0.00 2 1.00 33 0.00 0 0 1 1
6 0.00 1 1.00 5 0.00 0 0 1 1
5 0.00 8 0.00 60 0.00 0 0 0 1
4 0.25 9 0.00 48 0.00 0 0 0 1
45 0.00 3 1.00 50 0.02 0 0 0 1
30 0.03 2 1.00 41 0.00 0 0 0 1
24 0.00 1 1.00 36 0.00 0 0 0 1
38 0.00 50 0.00 2 1.00 0 0 0 1
22 0.00 44 0.00 3 1.00 0 0 0 1
9 0.00 60 0.00 2 1.00 0 0 0 1
6 0.00 35 0.00 3 1.00 0 0 0 1
2 0.00 40 0.00 6 1.00 0 0 1 0
3 0.00 52 0.00 8 1.00 0 0 1 0
4 0.00 31 0.00 5 1.00 0 0 1 0
3 0.00 52 0.00 48 0.00 0 0 1 1
4 0.00 37 0.00 61 0.00 0 0 1 1
7 1.00 3 0.00 8 1.00 0 0 0 0
9 1.00 7 1.00 6 1.00 0 0 0 0
8 1.00 60 0.00 3 1.00 0 0 0 0
6 1.00 2 0.00 7 1.00 0 0 0 0
6 0.00 2 1.00 -1 0 0 0 0 0
9 0.11 3 1.00 -1 0 0 0 0 0
12 0.00 1 1.00 -1 0 0 0 0 0
15 0.00 4 1.00 -1 0 0 0 0 0
8 0.00 45 0.00 -1 0 0 0 0 1
7 0.00 55 0.00 60 0.00 0 0 0 1
11 0.09 48 0.00 52 0.00 0 0 0 1
4 0.00 30 0.00 36 0.00 0 0 0 1
5 1.00 40 0.00 45 0.00 0 0 0 1
4 1.00 28 0.00 33 0.00 0 0 0 1
1 0.00 4 1.00 2 1.00 0 0 0 0
2 0.00 1 1.00 3 1.00 0 0 0 0
2 0.00 5 1.00 4 1.00 0 0 1 0
10 0.20 2 1.00 4 1.00 0 0 0 0
16 0.06 3 1.00 1 1.00 0 0 0 0
80 0.02 4 1.00 3 1.00 0 0 0 1
26 0.04 2 1.00 1 1.00 0 0 0 1
34 0.00 1 1.00 2 1.00 0 0 0 1
6 0.00 -1 0 30 0.00 0 0 0 1
30 0.00 6 0.00 -1 0 0 0 0 1
6 0.00 7 0.00 5 0.00 0 0 0 1
2 0.00 2 0.00 3 0.00 0 0 0 1
1 0.00 1 0.00 1 0.00 0 0 0 1
3 0.00 2 0.00 2 0.00 0 0 0 1
50 0.04 12 0.10 3 1.00 0 0 0 1
28 0.00 -1 0 2 1.00 0 0 0 1
40 0.00 -1 0 3 1.00 0 0 0 1
27 0.00 2 1.00 -1 0 0 0 0 1
48 0.00 3 1.00 -1 0 0 0 0 1
"""


def labelled_table() -> list[tuple[list[float], int]]:
    rows = [[float(x) for x in line.split()] for line in LABELLED.strip().splitlines()]
    return [(r[:-1], int(r[-1])) for r in rows]


def impurity(labels: list[int]) -> float:
    p = sum(labels) / len(labels)
    return 2 * p * (1 - p)


def grow(rows: list[tuple[list[float], int]], least: int = 1, depth: int = 8):
    """A tree as (feature, threshold, left, right), or the label of a leaf (ties: main text)."""
    labels = [y for _, y in rows]
    leaf = int(2 * sum(labels) >= len(labels))
    if depth == 0 or impurity(labels) == 0:
        return leaf
    best = None
    for f in range(len(FEATURES)):
        values = sorted({x[f] for x, _ in rows})
        for low, high in zip(values, values[1:], strict=False):
            cut = (low + high) / 2
            left, right = [y for x, y in rows if x[f] <= cut], [y for x, y in rows if x[f] > cut]
            if min(len(left), len(right)) >= least:
                cost = (len(left) * impurity(left) + len(right) * impurity(right)) / len(rows)
                if best is None or cost < best[0] - 1e-12:
                    best = (cost, f, cut)
    if best is None:
        return leaf
    _, f, cut = best
    return (f, cut, grow([r for r in rows if r[0][f] <= cut], least, depth - 1),
            grow([r for r in rows if r[0][f] > cut], least, depth - 1))


@lru_cache(maxsize=1)
def tree():
    return grow(labelled_table())


def is_main(features: list[float]) -> bool:
    node = tree()
    while isinstance(node, tuple):
        node = node[2] if features[node[0]] <= node[1] else node[3]
    return bool(node)


def telling(value: str, inside: bool) -> set[str]:
    """The telling words of a class or id, of the names that are about a part and not about the page's layout."""
    out: set[str] = set()
    for token in value.split():
        words = [x.lower() for x in NAME_WORD.findall(token)]
        if not words or len(words) > 1 and (words[0] in LAYOUT_FIRST or words[-1] in LAYOUT_LAST):
            continue
        if inside and words[-1] not in HINTS and words[-1] not in PARTS:
            continue
        out |= HINTS.intersection(words)
    return out


class Open:
    """An element that is open: its name and what it and its ancestors say about the text inside."""

    __slots__ = ("name", "article", "aside", "firm", "link", "heading", "skipped")

    def __init__(self, name: str, attributes: str, up: Open | None, first: bool = False):
        """``first``: an article or main element before which the page has none that counts."""
        self.name = name
        inside = bool(up and up.article)
        self.article = int(inside or name in ARTICLE)
        # The head of an article belongs to it; a page's head doesn't.
        aside = name in ASIDE and not (name == "header" and inside)
        skipped, firm = name in SKIPPED, False
        if attributes and name not in ("html", "body"):
            for m in ATTRIBUTE.finditer(attributes):
                key, value = m[1].lower(), (m[2] or "").strip("\"'")
                if key == "role":
                    aside |= value.lower() in ASIDE_ROLES
                elif key in ("class", "id"):
                    named = telling(value, inside) - ({"header"} if inside else set())
                    if named and name not in ARTICLE:
                        aside, firm = True, firm or bool(named & FIRM)
                elif key == "hidden" or key == "aria-hidden" and value.lower() == "true":
                    skipped = True
                elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                    skipped = True
        self.firm = bool(up and up.firm) or firm
        kept = bool(up and up.aside) and not (first and not self.firm)
        self.aside = int(kept or aside)
        self.link = bool(up and up.link) or name == "a"
        self.heading = int(bool(up and up.heading) or name in HEADINGS)
        self.skipped = bool(up and up.skipped) or skipped


def blocks(page: str) -> list[tuple[str, list[float]]]:
    """(text, own features) of each block that has a word: words, links, article, aside, heading."""
    out: list[tuple[str, list[float]]] = []
    stack = [Open("", "", None)]
    met = False  # an article or main element outside comments, related items and adverts
    parts: list[tuple[str, Open]] = []

    def flush() -> None:
        if parts:
            texts = [(entities.unescape(t), o) for t, o in parts]
            text = " ".join("".join(t for t, _ in texts).split())
            if text:
                n = text.count(" ") + 1
                linked = sum(len(t.split()) for t, o in texts if o.link)
                o = next((o for t, o in texts if t.strip()), texts[0][1])
                out.append((text, [float(n), min(1.0, linked / n), o.article, o.aside, o.heading]))
            parts.clear()

    def say(text: str) -> None:
        if text and not stack[-1].skipped:
            parts.append((text, stack[-1]))

    at, end = 0, len(page)
    while at < end:
        m = TOKEN.search(page, at)
        if m is None:
            say(page[at:])
            break
        say(page[at: m.start()])
        at = m.end()
        name = m[2].lower() if m[2] else ""
        if not name:
            continue
        if name == "br":
            say(" ")
            continue
        if name not in INLINE:
            flush()
        if m[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name == name:
                    del stack[i:]
                    break
            continue
        if name in EMPTY:
            continue
        shut = CLOSES.get(name, ("p",) if name not in INLINE else ())
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].name in shut:
                del stack[i:]
                break
            if stack[i].name in ("table", "ul", "ol", "dl", "div", "article", "section", "td", "th", "button", "body"):
                break
        if name in RAW:
            close = re.compile(rf"</{name}[\s>/]", re.I).search(page, at)
            at = close.start() if close else end
        first = name in ARTICLE and not met and not stack[-1].firm
        met = met or first
        stack.append(Open(name, m[3], stack[-1], first))
    flush()
    return out


def main_text(page: str | None) -> str:
    found = blocks(page or "")
    none = [-1.0, 0.0]
    kept = []
    for i, (text, own) in enumerate(found):
        before = found[i - 1][1][:2] if i else none
        after = found[i + 1][1][:2] if i + 1 < len(found) else none
        if is_main([*own[:2], *before, *after, *own[2:]]):
            kept.append(text)
    return "\n\n".join(kept)


def extract_text(df: DataFrame, html: str = "html", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """Append the main text of each page and its length in code points."""

    @F.pandas_udf("string")
    def extracted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pages.map(main_text)

    return with_results(df, {text: extracted(F.coalesce(df[html], F.lit("")))}).withColumn(
        n_chars, F.char_length(F.col(text)).cast("long"))
