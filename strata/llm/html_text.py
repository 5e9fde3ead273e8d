"""Main text of web pages by minimum-cut labelling of their blocks.

A page is cut into text blocks.  A linear classifier scores each block, and
the scores become capacities to the two terminals; blocks that follow each
other and blocks below the same element are tied by smoothness edges.  The
minimum cut, found by maximum flow, is the labelling of least total cost: a
short paragraph between long ones stays, a sentence inside a menu goes.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of the HTML standard by their part here.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section select summary table tbody td tfoot th thead tr ul button".split()
)
_CLOSES_P = _BLOCK - {"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option", "optgroup", "button", "select"}
#: An opening tag ends an open element of these names, down to the nearest of the others.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select", "optgroup"}),
    "a": ({"a"}, _BLOCK),
}
_SCOPES = frozenset("html body table td th caption".split())
#: Elements whose text is never the article's, and landmark roles that say the same.
_APART = frozenset("nav footer aside form noscript template select button object svg canvas dialog menu head search".split())
_APART_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar".split())
#: Words of class and id names, as sites commonly use them.
_BAD = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner menu menus nav navbar "
    "navigation breadcrumb breadcrumbs footer copyright legal disclaimer sidebar aside rail widget widgets related "
    "recommended recommendations share sharing social newsletter subscribe subscription signup login signin register "
    "cookie cookies consent gdpr notice notices popup modal overlay toolbar pager pagination tagcloud masthead topbar "
    "comment comments commentlist disqus respond reply replies discussion".split()
)
_COMMENT = frozenset("comment comments commentlist disqus respond reply replies discussion".split())
_HEADER = frozenset("header head top".split())
_GOOD = frozenset("article content post entry story main prose articlebody".split())

INFINITE = 10**7
#: Costs in hundredths.  Scores above 0 speak for the article.
WEIGHTS = {
    "base": -50,
    "word": 10,  # a word, up to 50
    "sentence": 150,  # ends like a sentence
    "heading": 150,
    "link": -600,  # all of it is links
    "inside": 400,  # in an article or main element
    "outside": -400,  # not, on a page that has one
    "good": 150,
    "bad": -1500,
    "rights": -300,
    "adjacent": 100,  # tie of neighbours with one parent; less with their distance in the tree
    "parent": 40,  # tie of a block or element to its parent element
}

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_SPECIAL = re.compile(r"[>\"']")
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORDS = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")
_NO_BOX = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|$)", re.I) for name in _RAW}


@dataclass
class Element:
    tag: str
    parent: int
    depth: int
    good: bool = False
    bad: bool = False
    comment: bool = False
    apart: bool = False
    region: bool = False
    hidden: bool = False
    chars: int = 0


@dataclass
class Block:
    parent: int
    text: str
    links: int
    tag: str
    score: int = 0
    marked: bool = False
    content: bool = False


@dataclass
class Page:
    elements: list[Element] = field(default_factory=lambda: [Element("", 0, 0)])
    blocks: list[Block] = field(default_factory=list)


def tokens(html: str) -> Iterator[tuple[str, str, str]]:
    """``("text", text, "")``, ``("open", name, attributes)`` and ``("close", name, "")``; linear in the page.

    Comments, doctypes and raw text (scripts, styles, titles) are left out; a
    tag that the page's end cuts off is, too.
    """
    at, held, n = 0, 0, len(html)
    gone = {'"': False, "'": False}  # no such quote after this point
    while True:
        lt = html.find("<", at)
        if lt < 0 or lt + 1 >= n:
            break
        c = html[lt + 1]
        if c.isascii() and c.isalpha():
            if lt > held:
                yield "text", html[held:lt], ""
            name = _NAME.match(html, lt + 1)
            end = start = name.end()
            while True:
                m = _SPECIAL.search(html, end)
                if m is None:
                    return
                end = m.end()
                if (q := m.group()) == ">":
                    break
                close = -1 if gone[q] else html.find(q, end)
                if close < 0:
                    gone[q] = True
                else:
                    end = close + 1
            tag = name.group().lower()
            yield "open", tag, html[start : end - 1]
            at = held = end
            if tag in _RAW and not html[start : end - 1].endswith("/"):
                m = _RAW_END[tag].search(html, at)
                if m is None:
                    return
                at = held = m.start()
            continue
        if c in "!?/":
            if lt > held:
                yield "text", html[held:lt], ""
            if html.startswith("<!--", lt):
                close = html.find("-->", lt + 2)  # <!--> is a whole comment
                end = close + 3
            else:
                close = html.find(">", lt)
                end = close + 1
            if close < 0:
                return
            if c == "/" and (name := _NAME.match(html, lt + 2)):
                yield "close", name.group().lower(), ""
            at = held = end
            continue
        at = lt + 1
    if held < n:
        yield "text", html[held:], ""


def _element(tag: str, attributes: str, parent: int, depth: int) -> Element:
    e = Element(tag, parent, depth, apart=tag in _APART, region=tag in ("article", "main"))
    if not attributes.strip():
        return e
    cues: set[str] = set()
    for m in _ATTR.finditer(attributes):
        name = m.group(1).lower()
        value = unescape(m.group(2) or m.group(3) or m.group(4) or "")
        if name in ("class", "id") and tag not in ("html", "body"):
            cues.update(w.lower() for w in _WORDS.findall(value))
        elif name == "role":
            e.apart |= value.strip().lower() in _APART_ROLES
            e.region |= value.strip().lower() in ("main", "article")
        elif name == "itemprop" and value.strip().lower() == "articlebody":
            e.region = True
        elif name == "hidden" or (name == "aria-hidden" and value.strip().lower() == "true"):
            e.hidden = True
        elif name == "style" and _NO_BOX.search(value):
            e.hidden = True
    e.good, e.comment = not cues.isdisjoint(_GOOD), not cues.isdisjoint(_COMMENT)
    e.bad = e.comment or not cues.isdisjoint(_BAD) or (not e.good and not cues.isdisjoint(_HEADER))
    if e.comment:
        e.region = False
    return e


def parse(html: str) -> Page:
    """Elements and text blocks of a page, with the end tags that HTML lets authors leave out."""
    page = Page()
    elements, blocks = page.elements, page.blocks
    stack, open_ = [0], Counter()
    parts: list[str] = []
    links = 0

    def flush() -> None:
        nonlocal links
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                holder = next(k for k in reversed(stack) if k == 0 or elements[k].tag in _BLOCK)
                blocks.append(Block(holder, text, links, elements[holder].tag))
            parts.clear()
        links = 0

    def close(names: set[str] | frozenset[str], until: set[str] | frozenset[str]) -> None:
        """Ends the outermost open element of ``names`` above the nearest of ``until``."""
        if not any(open_[name] for name in names):
            return
        found = 0
        for at in range(len(stack) - 1, 0, -1):
            tag = elements[stack[at]].tag
            if tag in names:
                found = at
            elif tag in until:
                break
        if found:
            if any(elements[k].tag in _BLOCK for k in stack[found:]):
                flush()
            for k in stack[found:]:
                open_[elements[k].tag] -= 1
            del stack[found:]

    for kind, value, attributes in tokens(html):
        if kind == "text":
            value = unescape(value)
            parts.append(value)
            if open_["a"]:
                links += len("".join(value.split()))
        elif kind == "open":
            if value == "br":
                parts.append(" ")
                continue
            if value in _CLOSES_P:
                close({"p"}, _SCOPES | {"button"})
            if value in _ENDS:
                close(*_ENDS[value])
            if value in _BLOCK:
                flush()
            if value in _VOID or value in _RAW or (attributes.endswith("/") and value not in _BLOCK):
                continue
            elements.append(_element(value, attributes, stack[-1], len(stack)))
            stack.append(len(elements) - 1)
            open_[value] += 1
        elif open_[value]:
            stop = _SCOPES - {value} if value in _BLOCK else _BLOCK
            for at in range(len(stack) - 1, 0, -1):
                tag = elements[stack[at]].tag
                if tag == value:
                    if value in _BLOCK:
                        flush()
                    for k in stack[at:]:
                        open_[elements[k].tag] -= 1
                    del stack[at:]
                    break
                if tag in stop:
                    break
    flush()
    return page


def classify(page: Page, weights: dict[str, int] = WEIGHTS) -> None:
    """Sets the score of every block.

    A class name, form or menu speaks against a block only where it does not
    hold the page's article: an element around an article or main element, or
    around more than half of the page's unlinked text, is its frame.
    """
    elements, blocks, w = page.elements, page.blocks, weights
    for b in blocks:
        elements[b.parent].chars += max(0, len(b.text) - b.links)
    frame = [False] * len(elements)
    for k in range(len(elements) - 1, 0, -1):  # children come after their parents
        e = elements[k]
        elements[e.parent].chars += e.chars
        frame[e.parent] |= frame[k] or e.region
    whole = elements[0].chars
    state = [(False, False, False, False)] * len(elements)  # apart, bad, good, in a region
    for k in range(1, len(elements)):
        e = elements[k]
        apart, bad, good, inside = state[e.parent]
        holds = frame[k] or e.region
        wide = holds or 2 * e.chars > whole
        apart |= e.hidden or (e.apart and not (holds or (e.tag == "form" and wide)))
        apart |= e.tag == "header" and not inside and not holds
        bad |= (e.bad and not wide) or (e.comment and not frame[k])
        state[k] = apart, bad, good or e.good, inside or e.region
    has_region = any(state[b.parent][3] and not any(state[b.parent][:2]) for b in blocks)
    for b in blocks:
        apart, bad, good, inside = state[b.parent]
        b.marked = apart or bad
        if apart:
            b.score = -INFINITE
            continue
        n = b.text.count(" ") + 1
        low = b.text.lower()
        b.score = (
            w["base"]
            + w["word"] * min(n, 50)
            + w["sentence"] * (n >= 3 and b.text[-1] in ".!?…。！？\"'”’»)")
            + w["heading"] * (b.tag in ("h1", "h2", "h3"))
            + w["link"] * min(b.links, len(b.text)) // len(b.text)
            + w["inside"] * inside
            + w["outside"] * (has_region and not inside)
            + w["good"] * good
            + w["bad"] * bad
            + w["rights"] * (low.startswith(("©", "copyright", "(c)")) or "all rights reserved" in low)
        )


def ties(page: Page, weights: dict[str, int] = WEIGHTS) -> tuple[int, list[tuple[int, int, int]]]:
    """Nodes (blocks, then elements) and smoothness edges ``(node, node, capacity)`` of a page.

    Blocks below a marked element (an advert between two paragraphs) say
    nothing of their neighbours: the blocks around them are tied to each other.
    """
    elements, blocks = page.elements, page.blocks
    edges = []
    free = [k for k, b in enumerate(blocks) if not b.marked]
    for j, k in zip(free, free[1:]):
        a, b, steps = blocks[j].parent, blocks[k].parent, 0
        while a != b:
            if elements[a].depth >= elements[b].depth:
                a = elements[a].parent
            else:
                b = elements[b].parent
            steps += 1
        edges.append((j, k, weights["adjacent"] // (1 + steps)))
    # elements that tie something: from every block up, once
    node: dict[int, int] = {}
    for k in free:
        low, e = k, blocks[k].parent
        while e:
            known = e in node
            here = node.setdefault(e, len(blocks) + len(node))
            edges.append((low, here, weights["parent"]))
            if known:
                break
            low, e = here, elements[e].parent
    return len(blocks) + len(node), edges


def minimum_cut(scores: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Which nodes are on the source side of the least minimum cut.

    A positive score is the capacity from the source, a negative one to the
    sink, an edge ties both ways.  Dinic's algorithm: blocking flows along
    shortest residual paths.
    """
    n = len(scores)
    source, sink = n, n + 1
    to, room = [], []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def arc(a: int, b: int, there: int, back: int) -> None:
        out[a].append(len(to))
        out[b].append(len(to) + 1)
        to.extend((b, a))
        room.extend((there, back))

    for k, s in enumerate(scores):
        if s > 0:
            arc(source, k, s, 0)
        elif s < 0:
            arc(k, sink, -s, 0)
    for a, b, c in edges:
        if c > 0:
            arc(a, b, c, c)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue and level[sink] < 0:
            a = queue.popleft()
            for k in out[a]:
                if room[k] and level[to[k]] < 0:
                    level[to[k]] = level[a] + 1
                    queue.append(to[k])
        if level[sink] < 0:
            return [x >= 0 for x in level[:n]]
        turn = [0] * (n + 2)
        path: list[int] = []
        at = source
        while True:
            if at == sink:
                least = min(room[k] for k in path)
                for k in path:
                    room[k] -= least
                    room[k ^ 1] += least
                cut = next(j for j, k in enumerate(path) if not room[k])
                at = to[path[cut] ^ 1]
                del path[cut:]
                continue
            arcs = out[at]
            while turn[at] < len(arcs):
                k = arcs[turn[at]]
                if room[k] and level[to[k]] == level[at] + 1:
                    path.append(k)
                    at = to[k]
                    break
                turn[at] += 1
            else:
                if at == source:
                    break
                at = to[path.pop() ^ 1]
                turn[at] += 1


def label(html: str, weights: dict[str, int] = WEIGHTS) -> list[Block]:
    """Blocks of a page with score and label."""
    page = parse(html)
    classify(page, weights)
    n, edges = ties(page, weights)
    cut = minimum_cut([b.score for b in page.blocks] + [0] * (n - len(page.blocks)), edges)
    for b, content in zip(page.blocks, cut):
        b.content = content
    return page.blocks


def _texts(weights: dict[str, int], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [label(h or "", weights) for h in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array(["\n".join(b.text for b in r if b.content) for r in rows], pa.string()),
                pa.array([len(r) for r in rows], pa.int64()),
                pa.array([sum(b.content for b in r) for r in rows], pa.int64()),
            ],
            ["page_id", "url", "text", "n_blocks", "n_content"],
        )


def main_texts(
    pages: DataFrame,
    *,
    weights: dict[str, int] | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """``(page_id, url, text, n_blocks, n_content)`` for every row, without a shuffle.

    ``text``: the blocks labelled content of the whole page, in order, one
    ``\\n`` between them; character references decoded, white space inside a
    block (line breaks included) one space, ends trimmed.  Null or empty html,
    and pages without content: empty text.  Text outside any tag is a block of
    its own; elements left open end where HTML ends them, or with the page.
    Null ids and urls and repeated rows pass row by row; empty table: empty
    result.  ``weights`` replaces :data:`WEIGHTS`.
    """
    return pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")
    ).mapInArrow(
        partial(_texts, weights or WEIGHTS),
        "page_id long, url string, text string, n_blocks long, n_content long",
    )


def page_texts(pages: DataFrame, **columns: str) -> DataFrame:
    """``(page_id, url, text, n_chars)`` of :func:`main_texts`; ``n_chars`` in code points."""
    return main_texts(pages, **columns).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"), "n_blocks", "n_content"
    )
