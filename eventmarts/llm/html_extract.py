"""HTML extraction by minimum-cut labelling.

1. A page becomes blocks: runs of text between block-level tags, with the elements
   around them.  Scripts, styles, forms' controls and other elements without prose
   give no blocks.  End tags that are missing are implied, stray ones ignored.
2. A linear classifier gives each block a cost of being boilerplate or content from
   the elements around it, its link density, length and wording.  Costs are the
   capacities from and to the terminals.
3. Neighbouring blocks, and blocks of one container through a node for the
   container, are joined by smoothness edges, weak where an element with a
   meaning of its own begins or ends.  The graph is linear in the page.
4. The maximum flow's minimum cut separates content from boilerplate.  Where both
   are equally cheap a block is content.

Pages are independent: rows are labelled where they are read, in batches bounded by
bytes, and nothing is shuffled.

Defined results: a null or empty page, or one without content, gives an empty text;
repeated rows are extracted each; an empty table gives an empty table.  Only the three
named columns are read.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>?", re.DOTALL)
_ATTRIBUTE = re.compile(
    r"(class|id|role|hidden|style|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?",
    re.IGNORECASE)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noscript iframe noembed noframes".split())
SILENT = frozenset("head script style textarea title xmp noscript iframe noembed noframes template svg "
                   "math canvas audio video object select button datalist map".split())
IN_HEAD = frozenset("head title meta link script style base noscript template".split())
BLOCK = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre "
    "search section summary table caption thead tbody tfoot tr td th ul legend option".split())
# a start tag closes these open elements, up to the nearest element of the second set
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select", "datalist"}),
}
_NOT_P = tuple(sorted(BLOCK - {"p"}))
BOILERPLATE_TAGS = frozenset("nav footer aside form menu dialog search".split())
CONTENT_TAGS = frozenset({"article", "main"})
_BAD_NAME = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|alert|"
    r"popup|modal|newsletter|subscri\w*|side-?bar|menu|nav\w*|footer|breadcrumbs?|comments?\w*|"
    r"repl(?:y|ies)|disqus|related|recommend\w*|share|sharing|social|widget|login|signup|search|"
    r"pagination|pager|copyright|legal|masthead|toolbar|skip-link)(?:$|[\s_-])", re.IGNORECASE)
_HEADER_NAME = re.compile(r"(?:^|[\s_-])(?:site-?)?header(?:$|[\s_-])", re.IGNORECASE)
_GOOD_NAME = re.compile(
    r"(?:^|[\s_-])(?:article|content|post|entry|story|text|prose)(?:$|[\s_-])|"
    r"(?:article|post|entry|story)-?(?:body|content|text)", re.IGNORECASE)
_BAD_ROLE = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert "
                      "menu menubar toolbar form".split())
_LEGAL = re.compile(r"^\s*(?:©|\(c\)\s|copyright\b)|\ball rights reserved\b", re.IGNORECASE)

# costs of the classifier
STRONG, OUTER = 60, 15


class Element:
    """An open element, with what the elements around it say, so that no one climbs."""

    __slots__ = ("tag", "parent", "hint", "silent", "number", "in_content", "holder", "meaning",
                 "nearest", "hints")

    def __init__(self, tag: str, parent: Element | None, hint: int, silent: bool, number: int):
        self.tag, self.parent, self.hint, self.silent, self.number = tag, parent, hint, silent, number
        around = parent or self
        self.in_content = tag in CONTENT_TAGS or (parent is not None and parent.in_content)
        # the nearest block or hinted element, the nearest hinted one, its hint, the sum of hints
        self.holder = self if parent is None or tag in BLOCK or hint else around.holder
        self.meaning = number if parent is None or hint else around.meaning
        self.nearest = hint if parent is None or hint else around.nearest
        self.hints = hint + (parent.hints if parent else 0)


class Block:
    __slots__ = ("text", "element", "link_chars")

    def __init__(self, text: str, element: Element, link_chars: int):
        self.text, self.element, self.link_chars = text, element, link_chars


def _hint(tag: str, attributes: str, in_content: bool) -> int:
    """1: begins boilerplate, -1: begins content, 0: says nothing."""
    hint = 1 if tag in BOILERPLATE_TAGS else -1 if tag in CONTENT_TAGS else 0
    if tag == "header" and not in_content:
        hint = 1
    if attributes and tag not in ("html", "body"):
        names = ""
        for key, *values in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), "".join(values)
            if key in ("class", "id"):
                names += " " + value
            elif key == "role" and value.lower() in _BAD_ROLE:
                return 1
            elif key == "role" and value.lower() in ("main", "article"):
                hint = hint or -1
            elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
                return 1
            elif key == "style" and "display:none" in value.replace(" ", "").lower():
                return 1
        if names and tag in BLOCK:
            if _BAD_NAME.search(names) or (not in_content and _HEADER_NAME.search(names)):
                return 1 if tag not in CONTENT_TAGS else -1
            if _GOOD_NAME.search(names):
                hint = hint or -1
    return hint


def parse(page: str) -> list[Block]:
    """The blocks of a page in order."""
    root = Element("", None, 0, False, 0)
    stack, blocks, text, link_chars, count = [root], [], [], 0, 1
    links = 0  # open links
    open_at: dict[str, list[int]] = {}  # places on the stack by tag
    block_at = [0]  # places of block elements
    at, n = 0, len(page)

    def flush() -> None:
        nonlocal link_chars
        if text:
            joined = " ".join(html.unescape("".join(text)).split())
            if joined:
                blocks.append(Block(joined, stack[-1].holder, min(link_chars, len(joined))))
            text.clear()
        link_chars = 0

    def top(tags) -> int:
        """Place of the innermost open element of some tags (0: none)."""
        return max((open_at[t][-1] for t in tags if open_at.get(t)), default=0)

    def pop_to(k: int) -> None:
        nonlocal links
        while len(stack) > k:
            tag = stack.pop().tag
            open_at[tag].pop()
            if tag in BLOCK:
                block_at.pop()
            if tag == "a":
                links -= 1

    def close(tags, until) -> None:
        k = top(tags)
        if k > top(until):
            pop_to(k)

    while at < n:
        m = _TOKEN.search(page, at)
        end = m.start() if m else n
        if end > at and not stack[-1].silent:
            text.append(page[at:end])
            if links:
                link_chars += end - at
        if not m:
            break
        at = m.end()
        tag = (m.group(2) or m.group(5) or "").lower()
        if not tag:
            continue
        closing = m.group(1) or m.group(4)
        attributes = m.group(3) or m.group(6) or ""
        if closing:
            k = top((tag,))
            # an inline end tag does not close the block around it
            if k and (tag in BLOCK or tag in SILENT or k > block_at[-1]):
                if tag in BLOCK or stack[k].hint:
                    flush()
                pop_to(k)
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag == "hr":
            flush()
        if tag in VOID:
            continue
        if tag not in IN_HEAD and any(e.tag == "head" for e in stack[1:3]):
            pop_to(next(k for k, e in enumerate(stack) if e.tag == "head"))
        inside = stack[-1]
        hint = _hint(tag, attributes, inside.in_content) if not inside.silent else 0
        if tag in BLOCK or hint:
            flush()
            if tag in IMPLIED:
                close(*IMPLIED[tag])
            if tag in BLOCK:  # a paragraph ends where the next block begins
                close(("p",), _NOT_P)
        if tag in SILENT and tag not in RAW and tag not in ("head", "button", "select"):
            flush()
        element = Element(tag, stack[-1], hint, inside.silent or tag in SILENT, count)
        count += 1
        if tag in RAW:
            # raw text up to its end tag; none: the rest of the page
            stop = re.compile(rf"</{tag}\b[^>]*>?", re.IGNORECASE).search(page, at)
            at = stop.end() if stop else n
            continue
        if attributes.endswith("/") and tag in ("svg", "path", "use"):
            continue
        open_at.setdefault(tag, []).append(len(stack))
        if tag in BLOCK:
            block_at.append(len(stack))
        stack.append(element)
        links += tag == "a"
    flush()
    return blocks


def cost(block: Block) -> int:
    """Above 0: cheaper as boilerplate by so much; below 0: as content."""
    around = block.element
    score = STRONG * around.nearest + OUTER * (around.hints - around.nearest)
    n_words = block.text.count(" ") + 1
    score += round(30 * block.link_chars / len(block.text))
    score -= min(20, n_words // 2)
    if n_words < 5:
        score += 4
    if block.text[-1] in ".!?:;\"'”»…":
        score -= 4
    if block.element.tag in ("p", "blockquote", "pre", "h1", "h2", "h3", "h4"):
        score -= 6
    elif block.element.tag in ("li", "td", "th", "dt", "legend", "summary"):
        score += 3
    if _LEGAL.search(block.text[:200]):
        score += 30
    return score


class FlowGraph:
    """Maximum flow by shortest augmenting levels (Dinic), without recursion."""

    def __init__(self, n: int):
        self.out: list[list[int]] = [[] for _ in range(n)]
        self.to: list[int] = []
        self.room: list[int] = []

    def edge(self, a: int, b: int, there: int, back: int = 0) -> None:
        self.out[a].append(len(self.to))
        self.to.append(b)
        self.room.append(there)
        self.out[b].append(len(self.to))
        self.to.append(a)
        self.room.append(back)

    def _levels(self, s: int) -> list[int]:
        level = [-1] * len(self.out)
        level[s] = 0
        queue = deque([s])
        while queue:
            a = queue.popleft()
            for e in self.out[a]:
                b = self.to[e]
                if self.room[e] and level[b] < 0:
                    level[b] = level[a] + 1
                    queue.append(b)
        return level

    def run(self, s: int, t: int) -> int:
        flow = 0
        while (level := self._levels(s))[t] >= 0:
            nxt = [0] * len(self.out)
            path: list[int] = []
            a = s
            while True:
                if a == t:
                    most = min(self.room[e] for e in path)
                    flow += most
                    for e in path:
                        self.room[e] -= most
                        self.room[e ^ 1] += most
                    k = next(i for i, e in enumerate(path) if not self.room[e])
                    a = self.to[path[k] ^ 1]
                    del path[k:]
                    continue
                edges = self.out[a]
                while nxt[a] < len(edges):
                    e = edges[nxt[a]]
                    if self.room[e] and level[self.to[e]] == level[a] + 1:
                        break
                    nxt[a] += 1
                else:
                    if a == s:
                        break
                    level[a] = -1
                    a = self.to[path.pop() ^ 1]
                    continue
                path.append(edges[nxt[a]])
                a = self.to[path[-1]]
        return flow

    def reaches(self, t: int) -> list[bool]:
        """Nodes from which ``t`` can still be reached."""
        seen = [False] * len(self.out)
        seen[t] = True
        queue = deque([t])
        while queue:
            b = queue.popleft()
            for e in self.out[b]:
                a = self.to[e]
                if self.room[e ^ 1] and not seen[a]:
                    seen[a] = True
                    queue.append(a)
        return seen


def label(blocks: list[Block]) -> list[bool]:
    """True for content, by the minimum cut."""
    containers: dict[int, int] = {}
    n = len(blocks)
    parents = []
    for b in blocks:
        chain, e = [], b.element
        while e and len(chain) < 3:
            chain.append(containers.setdefault(e.number, len(containers)))
            e = e.parent if not e.hint else None  # no pull across a meaningful element
        parents.append(chain)
    graph = FlowGraph(n + len(containers) + 2)
    source, sink = n + len(containers), n + len(containers) + 1
    linked = set()
    for i, b in enumerate(blocks):
        c = cost(b)
        if c > 0:
            graph.edge(i, sink, c)
        elif c < 0:
            graph.edge(source, i, -c)
        chain = parents[i]
        graph.edge(i, n + chain[0], 4, 4)
        for x, y in zip(chain, chain[1:]):
            if (x, y) not in linked:
                linked.add((x, y))
                graph.edge(n + x, n + y, 4, 4)
        if i:
            before = blocks[i - 1].element
            same = before is b.element or before.parent is b.element.parent
            weight = 1 if before.meaning != b.element.meaning else 6 if same else 3
            graph.edge(i - 1, i, weight, weight)
    graph.run(source, sink)
    lost = graph.reaches(sink)
    return [not lost[i] for i in range(n)]


def main_text(page: str | None) -> str:
    blocks = parse(page) if page else []
    return "\n\n".join(b.text for b, content in zip(blocks, label(blocks)) if content) if blocks else ""


def extract(pages: DataFrame, id_col: str = "page_id") -> DataFrame:
    """``id_col, url, text, n_chars`` for every row."""
    id_type = pages.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=[id_col, "url", "text", "n_chars"])

    return pages.select(id_col, F.col("url").cast("string").alias("url"), "html").mapInArrow(
        run, f"`{id_col}` {id_type}, url string, text string, n_chars long")
