"""Main text of web pages, by flat text blocks and a decision tree.

A page is read once into flat blocks: text between tags that start or end a block, with its number of words and its link
density (share of its characters inside links).  A block's features are its own words and link density, those of the
blocks before and after it, and what encloses it (a boilerplate or article container, a heading, a list item).  A small
decision tree, grown here on the labelled blocks of the pages in `labelled.py`, says which blocks are main text.

Defined cases: null, empty and text-less html give an empty text; comments, scripts, styles and other unseen parts never
become blocks; a tag or comment that the page's end cuts off is markup; repeated pages are extracted each; an empty table
gives no row; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.labelled import PAGES

# A quote opens a value after "=" alone; elsewhere, as in an unquoted value, it is a character like others.
VALUE = r"""(?:"[^"]*(?:"|\Z)|'[^']*(?:'|\Z)|[^\s>"'][^\s>]*|(?=>)|\Z)"""
MARKUP = re.compile(rf"<!--.*?(?:-->|\Z)|<(?:!|\?)[^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*{VALUE})*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"'][^\s>]*)))?""")
NAME_WORD = re.compile(r"[a-z]+")

# Names of the HTML standard, by what they do to blocks.
UNSEEN = {"script", "style", "noscript", "template", "svg", "math", "iframe", "object", "canvas", "audio", "video", "head",
          "title", "select", "option", "button", "textarea", "datalist"}
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "noframes"}
RAW_END = {tag: re.compile(f"</{tag}", re.I | re.A) for tag in RAW}  # sought in the page itself: lowering may lengthen it
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "input",
          "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time",
          "tt", "u", "var", "wbr", "link", "meta", "source", "track", "area", "nobr"}
SPACE = {"br", "wbr"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
OUTSIDE = {"nav", "footer", "aside", "form", "menu", "dialog", "search"}
ARTICLE = {"article", "main"}
# Words of class, id and role names that tell a container's purpose.
OUTSIDE_WORDS = {"nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "footer", "foot", "copyright", "sidebar", "aside",
                 "widget", "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "banner", "promo", "promotion", "sponsor",
                 "sponsored", "cookie", "cookies", "consent", "gdpr", "notice", "alert", "popup", "modal", "overlay", "newsletter",
                 "subscribe", "subscription", "signup", "login", "comment", "comments", "reply", "replies", "respond", "disqus", "discussion",
                 "share", "sharing", "social", "related", "recommended", "pagination", "pager", "toolbar", "search", "masthead",
                 "complementary", "contentinfo", "dialog", "disclaimer", "legal", "tags", "skip"}
PAGE_HEAD_WORDS = {"header", "head", "topbar"}  # outside an article
ARTICLE_WORDS = {"article", "story", "entry", "articlebody", "maincontent", "main", "content", "post"}


@dataclass
class Block:
    text: str
    words: int
    density: float
    outside: bool
    article: bool
    heading: bool
    item: bool
    marked: bool = False  # labelled pages mark their main blocks


def _container(tag: str, attributes: str, in_article: bool) -> tuple[bool, bool, bool]:
    """Whether an element is a boilerplate container, an article, and marked as main text."""
    outside, article, marked = tag in OUTSIDE or (tag == "header" and not in_article), tag in ARTICLE, False
    if attributes and tag not in ("body", "html"):
        for name, a, b, c in ATTRIBUTE.findall(attributes):
            name = name.lower()
            if name in ("class", "id", "role"):
                words = set(NAME_WORD.findall((a or b or c).lower()))
                outside |= bool(words & OUTSIDE_WORDS) or (not in_article and bool(words & PAGE_HEAD_WORDS))
                article |= bool(words & ARTICLE_WORDS) and not words & OUTSIDE_WORDS
            elif name == "data-main":
                marked = True
            elif name == "hidden" or (name == "aria-hidden" and (a or b or c) == "true"):
                outside = True
    return outside, article and not outside, marked


def blocks(page: str) -> list[Block]:
    """The page's flat blocks in order."""
    out: list[Block] = []
    stack: list[tuple[str, bool, bool, bool]] = []  # open elements that matter: tag, outside, article, marked
    outside = article = marked = heading = item = 0
    parts: list[str] = []
    linked = in_link = unseen = 0
    at = 0

    def flush() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                size = sum(len(p) for p in parts)
                out.append(Block(text, text.count(" ") + 1, min(1.0, linked / size), outside > 0, article > 0 and not outside,
                                 heading > 0, item > 0, marked > 0))
            parts, linked = [], 0

    def add(text: str) -> None:
        nonlocal linked
        if text and not unseen:
            text = html.unescape(text) if "&" in text else text
            parts.append(text)
            if in_link:
                linked += len(text)

    def close(k: int) -> None:
        """Leave the k-th open element and all in it."""
        nonlocal outside, article, marked, heading, item, in_link, unseen
        for tag, o, a, m in stack[k:]:
            outside -= o
            article -= a
            marked -= m
            heading -= tag in HEADINGS
            item -= tag == "li"
            in_link -= tag == "a"
            unseen -= tag in UNSEEN
        del stack[k:]

    while (m := MARKUP.search(page, at)) is not None:
        add(page[at : m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if tag not in INLINE:
            flush()
        if m[1]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    close(k)
                    break
            continue
        if tag in VOID:
            if tag in SPACE and not unseen:
                parts.append(" ")
            continue
        if tag in RAW:
            end = RAW_END[tag].search(page, at)
            at = end.start() if end else len(page)
            if tag == "xmp" and not unseen:
                parts.append(page[m.end() : at])
        if tag in ("li", "a", "option") or tag in HEADINGS:  # these end an open one of their kind
            kinds = HEADINGS if tag in HEADINGS else {tag}
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in kinds:
                    close(k)
                    break
                if stack[k][0] in ("ul", "ol", "menu", "div", "table"):
                    break
        o, a, mk = _container(tag, m[3], article > 0)
        if m[3].rstrip().endswith("/") and tag in ("svg", "math"):
            continue
        if tag in INLINE and tag != "a" and not (o or a or mk):
            continue
        stack.append((tag, o, a, mk))
        outside += o
        article += a
        marked += mk
        heading += tag in HEADINGS
        item += tag == "li"
        in_link += tag == "a"
        unseen += tag in UNSEEN
    tail = page[at:]
    cut = re.search(r"<[/!?a-zA-Z]", tail)
    add(tail[: cut.start()] if cut else tail)
    flush()
    return out


def features(page: list[Block]) -> np.ndarray:
    """Own, previous and next words and link density, then outside, article, heading, list item."""
    n = len(page)
    own = np.array([(b.words, b.density) for b in page], float).reshape(n, 2)
    pad = np.zeros((1, 2))
    around = np.concatenate([own, np.concatenate([pad, own])[:-1] if n else own, np.concatenate([own, pad])[1:] if n else own], axis=1)
    kind = np.array([(b.outside, b.article, b.heading, b.item) for b in page], float).reshape(n, 4)
    return np.concatenate([around, kind], axis=1)


@dataclass
class Node:
    share: float  # of main text among its examples
    feature: int = -1
    limit: float = 0.0
    low: Node | None = None
    high: Node | None = None


def grow(x: np.ndarray, y: np.ndarray, depth: int = 8, least: int = 2) -> Node:
    """A tree that splits by the feature and limit with the least Gini impurity."""
    node = Node(float(y.mean()))
    if depth == 0 or len(y) < 2 * least or node.share in (0.0, 1.0):
        return node
    best = (len(y) * 2 * node.share * (1 - node.share) - 1e-9, -1, 0.0)
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v, yes = x[order, f], np.cumsum(y[order])
        cut = np.flatnonzero(v[1:] > v[:-1]) + 1
        cut = cut[(cut >= least) & (cut <= len(y) - least)]
        if not len(cut):
            continue
        left, total = yes[cut - 1], yes[-1]
        right, size = total - left, len(y) - cut
        cost = 2 * left * (1 - left / cut) + 2 * right * (1 - right / size)
        k = int(cost.argmin())
        if cost[k] < best[0]:
            best = (float(cost[k]), f, float(v[cut[k] - 1] + v[cut[k]]) / 2)
    if best[1] < 0:
        return node
    node.feature, node.limit = best[1], best[2]
    low = x[:, node.feature] <= node.limit
    node.low, node.high = grow(x[low], y[low], depth - 1, least), grow(x[~low], y[~low], depth - 1, least)
    return node


def judge(node: Node, x: np.ndarray) -> np.ndarray:
    """Whether each row is main text."""
    if node.feature < 0:
        return np.full(len(x), node.share > 0.5)
    out = np.empty(len(x), bool)
    low = x[:, node.feature] <= node.limit
    out[low], out[~low] = judge(node.low, x[low]), judge(node.high, x[~low])
    return out


@lru_cache(maxsize=1)
def trained() -> Node:
    """The tree of the labelled pages."""
    pages = [blocks(p) for p in PAGES]
    return grow(np.concatenate([features(p) for p in pages]), np.array([b.marked for p in pages for b in p], float))


def main_text(page: str | None, tree: Node) -> str:
    found = blocks(page) if page else []
    if not found:
        return ""
    return "\n\n".join(b.text for b, keep in zip(found, judge(tree, features(found)), strict=True) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of each page."""
    tree = trained()
    kinds = {c: pages.schema[c].dataType.simpleString() for c in ("page_id", "url")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([main_text(h, tree) for h in b.column(2).to_pylist()], pa.string())],
                names=["page_id", "url", "text"])

    rows = pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
    return rows.withColumn("n_chars", F.length("text").cast("long"))
