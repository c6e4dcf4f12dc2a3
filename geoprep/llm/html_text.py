"""Operator 2: main-text extraction by tree scoring.

One pass over the mark-up builds a light tree of its elements and a list of text blocks.
Every paragraph passes points (for its length and its commas, less the share of it that
is link text) to its parent in full, its grandparent by half, and less to further
ancestors; the container whose points, discounted by its link density, are highest wins.
If it lies in an ``article`` that whole article is taken, and if most of its text is in
one article, that article.  Siblings with a fair share of the winner's points are kept too;
beside an article these are the articles of a quarter of its text or more, few links in it.

Left out wherever they stand: scripts, styles, menus, page headers and footers, sidebars,
notices, adverts, forms and reader comments, told by element, ``role``, ``hidden`` or a word
of ``class`` or ``id``.  A form, or a block told by a word alone, stays (with fewer points) if
it holds a ``main``, the page's only articles or most of the page's points, or, inside an
article, if it has a quarter of the page's points, few links, and the word is only part of a name
(``related-work``).  Comments inside an article go however long they are; ``no-sidebar`` and the like say nothing.  A header
inside an article keeps its headings and its paragraphs of prose (``PROSE`` characters or more,
ended as a sentence, few links).  Inside the chosen container, lists and boxes that are mostly
links go, unless it is an article.

Elements are opened and closed in constant time, so a page costs time in its length, however deep
its mark-up or wrong its closing tags.

A block's text has character references decoded, each run of white space (``br`` counts as
such) as one space, and no space at its ends; blocks are joined in page order by a newline.

Null, empty and tag-only pages give an empty text; cut-off mark-up is closed at the end of
the page; a page is handled alone, so repeated rows and other columns do not matter; an
empty table gives an empty result.  Nothing is cut: all blocks of all sizes are kept.
"""

from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"""
                  r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
                  r"""|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|</[^>]*(?:>|\Z)""", re.S)
_ATTR = re.compile(r"""([a-zA-Z:_-]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
BLOCKS = HEADINGS | set("""address article aside blockquote body caption center dd details dialog div dl dt fieldset
figcaption figure footer form header hr html legend li main menu nav ol option p pre section summary table tbody td
tfoot th thead tr ul""".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = {t: re.compile(rf"</{t}[\s/>]|\Z", re.I) for t in
       "script style textarea title noscript iframe xmp noembed noframes".split()}
DROPPED = set("""aside button canvas datalist dialog footer head iframe math menu nav noembed noframes noscript object
script select style svg template textarea title""".split())
ROLES = set("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
UNLIKELY = set("""ad ads adv advert adverts advertisement advertisements advertising sponsor sponsors sponsored promo promos
promotion promotions banner banners cookie cookies consent gdpr notice notices newsletter newsletters subscribe
subscription signup sidebar sidebars sidenav menu menus nav navbar navigation breadcrumb breadcrumbs footer footers comment
comments commentlist disqus respond reply replies share sharing social related recommended recommendations popup popups
modal overlay pager pagination widget widgets toolbar login outbrain taboola""".split())
HEADER_LIKE = {"header", "masthead", "topbar"}
LIKELY = set("article body content entry main post story text".split())
CLOSES = {"li": ("li", {"ul", "ol", "menu"}), "dt": ("dd", {"dl"}), "dd": ("dt", {"dl"}), "tr": ("tr", {"table"}),
          "td": ("td", {"tr", "table"}), "th": ("th", {"tr", "table"}), "option": ("option", {"select"})}
START = {"article": 25.0, "main": 25.0, "div": 5.0, "section": 5.0, "blockquote": 3.0, "pre": 3.0, "td": 3.0,
         "ul": -3.0, "ol": -3.0, "dl": -3.0, "li": -3.0}
LEVELS = 5              # ancestors a paragraph passes points to
KEEP, DROP, HEADINGS_ONLY, DOUBTFUL, HARDLY, COMMENTS = 0, 1, 2, 3, 4, 5
READERS = set("comment comments commentlist disqus respond reply replies".split())
PROSE, FEW_LINKS, SHARE = 80, 0.2, 0.25
SENTENCE = re.compile(r"[.!?\u2026\u3002][\"'\u2019\u201d)\]]*$")
STATUS = re.compile(r"(?<!\S)(?:(?:no|has|with|without|hide)[-_]\S+|\S+[-_](?:closed|open|off|disabled))(?!\S)", re.I)


def _judge(tag: str, attrs: str, known: dict) -> tuple[int, float]:
    """(0 keep, 1 drop, 2 header-like, 3 dropped unless it holds the text, 4 or a good part of an
    article, 5 the same as 3 but for comments; points the element starts with)."""
    got = known.get((tag, attrs))
    if got is not None:
        return got
    state, points = (DROP if tag in DROPPED else KEEP), START.get(tag, 0.0)
    if tag == "form":
        state = DOUBTFUL
    if tag == "header":
        state = HEADINGS_ONLY
    if attrs and not attrs.isspace() and tag not in ("html", "body"):
        values = {k.lower(): html.unescape(v.strip("\"'")) for k, v in _ATTR.findall(attrs)}
        words = {w.lower() for k in ("class", "id") for w in _WORD.findall(STATUS.sub(" ", values.get(k, "")))}
        whole = {w.lower() for k in ("class", "id") for w in values.get(k, "").split()}
        if "hidden" in values or values.get("aria-hidden") == "true" or values.get("role", "").lower() in ROLES \
                or re.search(r"display\s*:\s*none", values.get("style", "")):
            state = DROP
        elif tag not in ("article", "main") or words & {"comment", "comments"}:
            if words & UNLIKELY:
                sure = state == DROP or tag not in BLOCKS or tag in ("article", "main") or whole & READERS
                part = state == KEEP and not words & READERS and not whole & UNLIKELY
                state, points = DROP if sure else HARDLY if part else COMMENTS if words & READERS else DOUBTFUL, points - 25.0
            elif words & HEADER_LIKE and tag not in HEADINGS:
                state = HEADINGS_ONLY if state in (KEEP, HEADINGS_ONLY) else state
        points += 25.0 if words & LIKELY else 0.0
    if len(known) < 100_000:
        known[tag, attrs] = state, points
    return state, points


class _Page:
    """Elements in page order (parent before child) and the text blocks between them."""

    def __init__(self, known: dict):
        self.known = known
        self.parent, self.tag, self.state, self.points = [-1], ["#page"], [KEEP], [0.0]
        self.in_article = [False]
        self.doubtful: list[int] = []
        self.parts: set[int] = set()                      # doubtful ones that a good part of an article may be
        self.said: set[int] = set()                       # comments inside an article, by part of their name
        self.leads: set[int] = set()                      # paragraphs of an article's header
        self.stack = [0]
        self.open: dict[str, list[int]] = {}              # places in the stack by tag
        self.boxes = [0]                                  # and those of block elements other than p
        self.blocks: list[tuple[int, str, int]] = []      # element, text, link characters
        self.buffer: list[str] = []
        self.links = self.in_link = 0

    def flush(self) -> None:
        if self.buffer:
            text = " ".join("".join(self.buffer).split())
            if text:
                block = self.stack[max(self.boxes[-1], self.last("p"))]
                self.blocks.append((block, text, min(self.links, len(text))))
            self.buffer.clear()
        self.links = 0

    def text(self, s: str) -> None:
        if s and self.state[self.stack[-1]] == KEEP:
            if "&" in s:
                s = html.unescape(s)
            self.buffer.append(s)
            if self.in_link:
                self.links += len(s)

    def last(self, tag: str) -> int:
        """The place of the innermost open element of that tag, 0 if none is open."""
        places = self.open.get(tag)
        return places[-1] if places else 0

    def pop_to(self, k: int) -> None:
        """Close the elements from place ``k`` of the stack on."""
        if max(self.boxes[-1], self.last("p")) >= k:
            self.flush()
        for n in reversed(self.stack[k:]):
            self.open[self.tag[n]].pop()
            if self.tag[n] in BLOCKS and self.tag[n] != "p":
                self.boxes.pop()
            self.in_link -= self.tag[n] == "a"
        del self.stack[k:]

    def find(self, tag: str, fence: int = 0) -> int:
        """The place of the innermost open ``tag``, 0 if there is none after the place ``fence``."""
        k = self.last(tag)
        return k if k > fence else 0

    def start(self, tag: str, attrs: str) -> None:
        if tag == "br":
            self.text(" ")
            return
        if tag in BLOCKS:
            self.flush()
            k = self.find("p", self.boxes[-1])
            if k:
                self.pop_to(k)
            if tag in CLOSES:
                for other in {tag, CLOSES[tag][0]}:
                    k = self.find(other, max(map(self.last, CLOSES[tag][1])))
                    if k:
                        self.pop_to(k)
        if tag in VOID:
            return
        up = self.stack[-1]
        state, points = _judge(tag, attrs, self.known)
        article = self.in_article[up] or tag in ("article", "main")
        if state == HEADINGS_ONLY and not self.in_article[up]:
            state = DROP
        if self.state[up] == DROP or state == DROP or (state >= DOUBTFUL and self.state[up] == HEADINGS_ONLY):
            state = DROP
        elif state >= DOUBTFUL:
            self.doubtful.append(len(self.tag))
            if state == HARDLY and self.in_article[up]:
                self.parts.add(len(self.tag))
            if state == COMMENTS and self.in_article[up]:
                self.said.add(len(self.tag))
            state = KEEP
        elif self.state[up] == HEADINGS_ONLY:
            if tag == "p":
                self.leads.add(len(self.tag))
            state = KEEP if tag in HEADINGS or tag == "p" else HEADINGS_ONLY
        self.parent.append(up)
        self.tag.append(tag)
        self.state.append(state)
        self.points.append(points)
        self.in_article.append(article)
        self.open.setdefault(tag, []).append(len(self.stack))
        if tag in BLOCKS and tag != "p":
            self.boxes.append(len(self.stack))
        self.stack.append(len(self.tag) - 1)
        self.in_link += tag == "a"

    def end(self, tag: str) -> None:
        if tag in BLOCKS:
            self.flush()
            k = self.find(tag)
        else:
            k = self.find(tag, max(self.boxes[-1], self.last("p")))
        if k:
            self.pop_to(k)

    def read(self, page: str) -> None:
        at = 0
        while True:
            m = _TAG.search(page, at)
            if m is None:
                self.text(page[at:])
                break
            self.text(page[at:m.start()])
            at = m.end()
            tag = m[2] or m[5]
            if tag:
                tag = tag.lower()
                if m[1] or m[4]:
                    self.end(tag)
                else:
                    attrs = m[3] if m[2] else m[6]
                    if tag in RAW:
                        at = RAW[tag].search(page, at).start()
                    elif not (attrs.endswith("/") and tag not in BLOCKS):
                        self.start(tag, attrs)
        self.flush()


def _worth(text: str, linked: int) -> float:
    return (min(1.0, len(text) / 25) + text.count(",") + min(len(text) / 100, 3.0)) * (1 - linked / len(text))


def _settle(p: _Page) -> None:
    """Drop the doubtful elements, but for those that hold the page's text."""
    n = len(p.tag)
    held, holds = [0.0] * n, [0] * n                  # points; articles, or a main
    size, links = [0] * n, [0] * n
    doubted = [False] * n
    for k in p.doubtful:
        doubted[k] = True
    under = list(doubted)
    for k in range(1, n):
        under[k] = under[k] or under[p.parent[k]]
        if p.state[k] == KEEP and p.tag[k] in ("article", "main"):
            holds[k] = 1
    mains = [k for k in range(n) if holds[k] and p.tag[k] == "main"]
    outside = any(holds[k] and not under[k] for k in range(n))
    for node, text, linked in p.blocks:
        size[node] += len(text)
        links[node] += linked
        if p.tag[node] not in HEADINGS:
            held[node] += _worth(text, linked)
    around = set()
    for k in mains:
        while k > 0 and k not in around:
            around.add(k)
            k = p.parent[k]
    for k in range(n - 1, 0, -1):
        held[p.parent[k]] += held[k]
        holds[p.parent[k]] += holds[k]
        size[p.parent[k]] += size[k]
        links[p.parent[k]] += links[k]
    for k in range(1, n):
        if p.state[p.parent[k]] == DROP:
            p.state[k] = DROP
        elif doubted[k] and not ((2 * held[k] > held[0] and k not in p.said) or k in around or (holds[k] and not outside and holds[k] == holds[0])
                                 or (k in p.parts and held[k] >= SHARE * held[0] and links[k] <= FEW_LINKS * size[k])):
            p.state[k] = DROP
    p.blocks = [b for b in p.blocks if p.state[b[0]] != DROP]


def main_text(page: str | None, known: dict | None = None) -> str:
    """The main text of one page."""
    if not page:
        return ""
    p = _Page({} if known is None else known)
    p.read(page)
    if p.leads:
        p.blocks = [(node, text, linked) for node, text, linked in p.blocks
                    if node not in p.leads or (len(text) >= PROSE and linked <= FEW_LINKS * len(text) and SENTENCE.search(text))]
    if p.doubtful:
        _settle(p)
    blocks = p.blocks
    if not blocks:
        return ""
    n = len(p.tag)
    score, size, links = list(p.points), [0] * n, [0] * n
    scored = [False] * n
    for node, text, linked in blocks:
        size[node] += len(text)
        links[node] += linked
        if p.tag[node] in HEADINGS:
            continue
        worth = _worth(text, linked)
        up = p.parent[node] if p.tag[node] in ("p", "pre", "li", "td", "dd", "blockquote") else node
        for level in range(LEVELS):
            if up < 0:
                break
            score[up] += worth / (1 if level == 0 else 2 if level == 1 else 3 * level)
            scored[up] = True
            up = p.parent[up]
    for k in range(n - 1, 0, -1):                    # children stand after their parents
        size[p.parent[k]] += size[k]
        links[p.parent[k]] += links[k]
    dense = [links[k] / size[k] if size[k] else 0.0 for k in range(n)]
    final = [score[k] * (1 - dense[k]) if scored[k] and p.state[k] != DROP else float("-inf") for k in range(n)]
    best = max(range(n), key=lambda k: (final[k], -k))
    if final[best] == float("-inf"):                 # headings alone
        best = 0
    best = _article(p, best, size)
    chosen = {best}
    if p.tag[best] == "article":
        least = SHARE * size[best]
        chosen |= {k for k in range(n) if p.parent[k] == p.parent[best] and p.tag[k] == "article" and p.state[k] == KEEP
                   and size[k] >= least and dense[k] <= FEW_LINKS}
    elif p.tag[best] != "main" and best:
        least = max(10.0, 0.2 * final[best])
        chosen |= {k for k in range(n) if p.parent[k] == p.parent[best] and final[k] >= least}
    keep, mostly_links = [False] * n, p.tag[best] not in ("article", "main")
    for k in range(n):
        inside = k in chosen or (k > 0 and keep[p.parent[k]])
        box = mostly_links and k not in chosen and dense[k] > 0.5 and p.tag[k] in ("ul", "ol", "div", "table", "section")
        keep[k] = inside and not box
    return "\n".join(text for node, text, _ in blocks if keep[node])


def _article(p: _Page, best: int, size: list[int]) -> int:
    """The outermost article around ``best``, or the one article that holds most of it."""
    found, k = 0, best
    while k > 0:
        if p.tag[k] == "article" and p.state[k] != DROP:
            found = k
        k = p.parent[k]
    if found:
        return found
    inside = [False] * len(p.tag)
    inside[best] = True
    for k in range(best + 1, len(p.tag)):
        inside[k] = inside[p.parent[k]]
    held = [k for k in range(best + 1, len(p.tag)) if inside[k] and p.tag[k] == "article" and p.state[k] != DROP]
    large = max(held, key=lambda k: size[k], default=0)
    return large if large and 2 * size[large] >= size[best] else best


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text for every page."""
    def extract(batches):
        known: dict = {}
        for pdf in slices(batches, "html"):
            texts = [main_text(h, known) if isinstance(h, str) else "" for h in pdf["html"]]
            yield pd.DataFrame({"page_id": pdf["page_id"], "url": pdf["url"], "text": texts})

    kind = dict(pages.select("page_id").dtypes)["page_id"]
    return pages.select(F.col("page_id").cast("string").alias("page_id"), "url", "html") \
        .mapInPandas(extract, "page_id string, url string, text string") \
        .select(F.col("page_id").cast(kind).alias("page_id"), "url", "text")
