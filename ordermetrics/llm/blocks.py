"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is read once as a flat run of blocks: text between two block-level tags, with its
number of words and the share of them that are links. What a block says of itself and what
its neighbours say, words and link density of each, goes to a decision tree together with
what the markup around it is named. The tree is trained on the small labelled table below;
pages themselves carry no labels. Pages are independent, so nothing is shuffled.
"""

from __future__ import annotations

import html as entities
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession

from ordermetrics.llm import words as w

# Elements whose content is text for the parser up to their end tag, and never shown as text.
RAW = ("script", "style", "title", "textarea", "xmp", "iframe", "noembed", "noframes")
# Elements without text of the page: machine parts and form controls.
SILENT = {"head", "noscript", "template", "svg", "math", "canvas", "object", "audio", "video", "map",
          "select", "button", "datalist", "form", "fieldset"}
AWAY = {"nav", "aside", "footer", "menu", "dialog", "header"}
BLOCKS = {
    "address", "article", "blockquote", "body", "caption", "center", "dd", "details", "dir", "div",
    "dl", "dt", "figcaption", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "hgroup", "hr", "html",
    "legend", "li", "main", "ol", "p", "pre", "search", "section", "summary", "table", "tbody", "td",
    "tfoot", "th", "thead", "tr", "ul"} | AWAY | SILENT
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
        "track", "wbr"}
# An open one of these ends where the next block begins.
SHORT_LIVED = {"p", "h1", "h2", "h3", "h4", "h5", "h6"}

# Parts of class, id and role names. Fixed values.
AWAY_NAMES = set("""
ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promotion
promoted banner nav navbar navigation menu breadcrumb breadcrumbs sidebar aside widget widgets
footer masthead topbar toolbar cookie cookies consent gdpr notice notices alert popup modal overlay
newsletter subscribe subscription signup login search share sharing social related recommended
recommendations comment comments commentlist reply replies respond responses disqus discussion
pagination pager copyright contentinfo complementary dialog skip
""".split())
MAIN_NAMES = set("article articlebody content main post entry story prose".split())

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""",
                 re.DOTALL)
OTHER_TAG = re.compile(r"<(?:[!?]|/[^a-zA-Z])[^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)([^>]*)(?:>|\Z)")
NAMED = re.compile(r"""(?<![\w-])(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(r"""(?<![\w-])hidden(?![\w-])|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
CAMEL = re.compile(r"([a-z])([A-Z])")

# The labelled table: page, elements around the block, words, words of them in links, 1 for main
# text. Pages with and without telling markup, so that the tree learns to do without.
LABELLED = """
1 nav/ul/li 1 1 0
1 nav/ul/li 2 2 0
1 nav/ul/li 1 1 0
1 div.ad 9 0 0
1 article/h1 7 0 1
1 article/p 60 0 1
1 article/p 2 0 1
1 article/p 130 3 1
1 article/p 1 0 1
1 footer 12 1 0
2 header/div 4 0 0
2 header/div 12 12 0
2 main/article/h1 5 0 1
2 main/article/p 45 2 1
2 main/article/ul/li 4 0 1
2 main/article/ul/li 6 0 1
2 main/article/aside 25 2 0
2 main/article/p 80 0 1
2 main/section.comments/p 40 0 0
2 main/section.comments/p 3 0 0
2 main/section.comments/p 70 1 0
2 footer/p 30 8 0
3 div/ul/li 1 1 0
3 div/ul/li 1 1 0
3 div/ul/li 2 2 0
3 div/h1 8 0 1
3 div/p 55 0 1
3 div/p 90 4 1
3 div/p 6 0 1
3 div/p 75 0 1
3 div/ul/li 5 5 0
3 div/ul/li 6 6 0
3 div/p 9 1 0
4 div.cookie-notice/p 30 2 0
4 div.content/h2 4 0 1
4 div.content/p 40 0 1
4 div.content/p 12 1 1
4 div.content/p 9 9 1
4 div.content/p 66 0 1
4 div.sidebar/p 35 0 0
4 div.sidebar/ul/li 4 4 0
4 div.newsletter/p 15 0 0
4 div 8 0 0
5 div 3 3 0
5 div 4 4 0
5 div 10 0 0
5 h1 6 0 1
5 p 30 0 1
5 p 28 1 1
5 p 3 0 1
5 p 44 0 1
5 div 6 5 0
5 div 5 5 0
5 div 11 2 0
6 div.banner 20 0 0
6 article/header/h1 9 0 1
6 article/p 3 0 1
6 article/p 4 0 1
6 article/ul.related/li 8 8 0
6 article/ul.related/li 7 7 0
6 article/div.comment/p 120 0 0
6 article/footer/p 9 2 0
6 div.promo/p 60 5 0
7 div/div 2 2 0
7 div/div 3 3 0
7 div/p 120 0 1
7 div/p 150 6 1
7 div/p 100 2 1
7 div/div 4 3 0
7 div/div 14 0 0
8 article/p 30 0 1
8 article/ul/li 3 3 0
8 article/ul/li 4 4 0
8 article/ul/li 3 3 0
8 article/p 5 0 1
8 article/p 1 1 1
8 article/p 42 0 1
8 div/p 50 0 0
8 div/p 4 0 0
9 main/p 20 0 1
9 main/p 4 0 1
9 main/h2 3 0 1
9 main/p 65 0 1
9 aside/p 80 0 0
9 div/p 40 0 0
10 article/h1 4 0 1
10 article/p 60 0 1
10 article/p 5 0 1
11 p 40 0 1
12 nav/a 4 4 0
12 article/p 50 0 1
13 article/h2 6 0 1
13 article/p 30 5 1
13 article/h2 3 0 1
13 article/p 20 10 1
13 article/h2 2 0 1
13 article/p 18 3 1
13 article/p 4 1 1
13 article/p 2 0 1
14 header/div 2 2 0
14 div.notice 25 0 0
14 main/div.menu 10 10 0
14 main/article/h1 12 0 1
14 main/article/p 1 0 1
14 main/article/p 2 2 1
14 main/article/p 90 40 1
14 main/article/div.share 3 3 0
14 main/article/p 7 0 1
14 main/div 12 0 0
14 main/div.comments/p 65 0 0
15 div.wrap/p 3 0 0
15 div.post/h1 5 0 1
15 div.post/p 8 0 1
15 div.post/p 33 6 1
15 div.post/li 2 0 1
15 div.post/p 70 0 1
15 div.wrap/p 21 0 0
16 div 1 1 0
16 div 1 1 0
16 p 14 0 1
16 p 65 0 1
16 p 24 3 1
16 p 9 0 1
16 p 52 0 1
17 h1 3 0 1
17 p 10 0 1
17 p 12 1 1
18 article/p 3 0 1
19 article/p 25 25 1
19 article/p 48 0 1
20 p 6 0 1
21 article/h1 5 5 1
21 article/p 70 0 1
21 article/ul/li 4 4 0
21 article/ul/li 5 5 0
21 article/ul/li 3 3 0
22 div 1 1 0
22 h1 5 0 1
22 p 38 1 1
22 p 2 0 1
22 p 60 0 1
22 div 2 2 0
22 div 4 0 0
23 div 3 2 0
23 h1 2 0 1
23 p 45 0 1
23 h2 4 0 1
23 p 55 2 1
23 div 1 1 0
23 div 3 0 0
24 div 2 2 0
24 div 2 0 0
24 h1 7 0 1
24 p 31 0 1
24 div 3 3 0
24 div 7 0 0
"""

FEATURES = ("words", "links", "words before", "links before", "words after", "links after",
            "named away", "markup", "heading")
FAR = 200.0


class Block(NamedTuple):
    text: str
    words: int
    linked: int
    away: bool
    markup: int
    heading: bool


class _Open(NamedTuple):
    tag: str
    silent: bool
    away: bool
    markup: int


def _names(attributes: str) -> set[str]:
    found = set()
    for match in NAMED.finditer(attributes):
        for token in (match[1] or match[2] or match[3] or "").split():
            if not token.lower().startswith(("has-", "with-", "no-", "is-")):
                found.update(re.split(r"[-_:]+", CAMEL.sub(r"\1-\2", token).lower()))
    return found


def _opened(parent: _Open, tag: str, attributes: str) -> _Open:
    silent = parent.silent or tag in SILENT
    away, markup = parent.away, parent.markup
    if tag == "article":
        markup = 2
    elif tag == "main":
        markup = max(markup, 1)
    elif tag in AWAY and not (tag == "header" and markup == 2):
        away = True
    if attributes and "=" in attributes or "hidden" in attributes:
        silent = silent or bool(HIDDEN.search(attributes))
        if tag not in ("body", "html"):
            names = _names(attributes)
            away = away or not names.isdisjoint(AWAY_NAMES)
            if not names.isdisjoint(MAIN_NAMES):
                markup = max(markup, 1)
    return _Open(tag, silent, away, markup)


def blocks(page: str) -> list[Block]:
    """The flat text blocks of a page. One scan, whatever the markup is; never fails."""
    found: list[Block] = []
    stack = [_Open("", False, False, 0)]
    open_tags: dict[str, int] = {}
    pieces: list[str] = []
    linked: list[str] = []
    links = 0

    def flush() -> None:
        if pieces:
            words = "".join(pieces).split()
            if words:
                top = stack[-1]
                found.append(Block(" ".join(words), len(words), len("".join(linked).split()),
                                   top.away, top.markup, top.tag[:1] == "h" and top.tag[1:].isdigit()))
            pieces.clear()
            linked.clear()

    def say(text: str) -> None:
        if text and not stack[-1].silent:
            text = entities.unescape(text) if "&" in text else text
            pieces.append(text)
            linked.append(text if links else " ")

    def close(tag: str) -> None:
        if open_tags.get(tag, 0):
            while True:
                top = stack.pop()
                open_tags[top.tag] -= 1
                if top.tag == tag:
                    return

    at, size = 0, len(page)
    while at < size:
        start = page.find("<", at)
        if start < 0:
            say(page[at:])
            break
        say(page[at:start])
        match = TAG.match(page, start) or OTHER_TAG.match(page, start)
        if not match:
            say("<")
            at = start + 1
            continue
        at = match.end()
        if not match[2]:
            continue
        closing, tag, attributes = match[1], match[2].lower(), match[3]
        if tag in RAW:
            if not closing:
                end = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else size
        elif tag == "a":
            links = 0 if closing else 1
        elif tag == "br":
            say(" ")
        elif tag in BLOCKS:
            flush()
            links = 0
            if closing:
                close(tag)
            else:
                if stack[-1].tag in SHORT_LIVED:
                    close(stack[-1].tag)
                if tag == "body":
                    close("head")
                if tag == "li" and stack[-1].tag == "li":
                    close("li")
                if tag not in VOID:
                    stack.append(_opened(stack[-1], tag, attributes))
                    open_tags[tag] = open_tags.get(tag, 0) + 1
    flush()
    return found


def features(found: list[Block]) -> np.ndarray:
    """One row a block: its own figures, those of its neighbours, and what the markup says."""
    n = len(found)
    out = np.zeros((n, len(FEATURES)))
    if not n:
        return out
    words = np.array([b.words for b in found], float)
    density = np.array([b.linked for b in found], float) / words
    words = np.minimum(words, FAR)
    away = np.array([b.away for b in found])
    markup = np.array([b.markup for b in found])
    out[:, 0], out[:, 1] = words, density
    out[1:, 2], out[1:, 3] = words[:-1], density[:-1]
    out[:-1, 4], out[:-1, 5] = words[1:], density[1:]
    out[:, 6] = away
    # 1 within the most telling markup of the page, 0 where none tells, -1 outside of it.
    best = markup[~away].max(initial=0)
    out[:, 7] = 0 if best == 0 else np.where(markup >= best, 1, -1)
    out[:, 8] = [b.heading for b in found]
    return out


def labelled() -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the table, read by the same functions as pages."""
    pages: dict[str, list[list[str]]] = {}
    for line in LABELLED.split("\n"):
        if line:
            number, *row = line.split()
            pages.setdefault(number, []).append(row)
    rows, labels = [], []
    for page in pages.values():
        text = ""
        for path, words, linked, label in page:
            parts = [part.partition(".") for part in path.split("/")]
            text += "".join(f'<{tag} class="{name}">' if name else f"<{tag}>" for tag, _, name in parts)
            text += f"<a>{'w ' * int(linked)}</a> {'w ' * (int(words) - int(linked))}"
            text += "".join(f"</{tag}>" for tag, _, _ in reversed(parts))
            labels.append(float(label))
        rows.append(features(blocks(text)))
    return np.concatenate(rows), np.array(labels)


class Tree(NamedTuple):
    """A fitted tree as arrays: inner nodes send a row left if its feature is at most the limit."""

    feature: np.ndarray
    limit: np.ndarray
    left: np.ndarray
    right: np.ndarray
    main: np.ndarray

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        at = np.zeros(len(rows), np.int64)
        while True:
            inner = np.flatnonzero(self.feature[at] >= 0)
            if not len(inner):
                return self.main[at]
            node = at[inner]
            low = rows[inner, self.feature[node]] <= self.limit[node]
            at[inner] = np.where(low, self.left[node], self.right[node])


def fit(spark: SparkSession) -> Tree:
    """A decision tree over the labelled table."""
    rows, labels = labelled()
    frame = spark.createDataFrame(
        [(Vectors.dense(row), label) for row, label in zip(rows.tolist(), labels.tolist())],
        ["features", "label"]).coalesce(1)
    model = DecisionTreeClassifier(maxDepth=12, maxBins=64, seed=1).fit(frame)
    nodes: list[list] = []

    def add(node) -> int:
        number = len(nodes)
        if node.subtreeDepth() == 0:
            nodes.append([-1, 0.0, 0, 0, node.prediction() > 0.5])
        else:
            nodes.append([node.split().featureIndex(), node.split().threshold(), 0, 0, False])
            nodes[number][2] = add(node.leftChild())
            nodes[number][3] = add(node.rightChild())
        return number

    add(model._java_obj.rootNode())
    return Tree(*(np.array(column) for column in zip(*nodes)))


def main_text(page: str | None, tree: Tree) -> str:
    """The main text of one page, its blocks joined by one space."""
    found = blocks(page or "")
    keep = tree(features(found))
    return " ".join(block.text for block, main in zip(found, keep) if main)


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    tree: Tree | None = None,
) -> DataFrame:
    """(page_id, url, text, n_chars): the main text of every page, in page order.

    Character references are decoded, white space inside a block becomes one space, and
    blocks are joined by one space. Null and empty pages, and pages without main text, give
    an empty text; a page of text without any tags is one block. Markup that is not closed,
    not opened or cut off is read as far as it goes. Repeated rows and ids are pages of their
    own, whole pages of any length are read in one scan, other columns are not read, and an
    empty table gives an empty one. A tree is fitted unless one is given, which runs small
    Spark jobs when called.
    """
    fitted = tree or fit(pages.sparkSession)
    names = ["page_id", "url", "text", "n_chars"]

    def run(batches):
        for batch in batches:
            for first, stop, _, _ in w.slices(batch, html_col):
                rows = w.strings(batch, html_col).slice(first, stop - first).to_pylist()
                texts = [main_text(row, fitted) for row in rows]
                yield pa.RecordBatch.from_arrays([
                    batch.column(id_col).slice(first, stop - first).cast(pa.int64()),
                    batch.column(url_col).slice(first, stop - first).cast(pa.string()),
                    pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names)

    return pages.select(id_col, url_col, html_col).mapInArrow(
        run, "page_id bigint, url string, text string, n_chars bigint")
