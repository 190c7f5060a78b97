"""Main text of web pages by tag-path ratios.

A page is taken apart into text nodes, each under the path of tags from the root to it. Nodes with one path share its
statistics: characters outside links per node, punctuation per node. Text and punctuation ratios are smoothed over
neighbouring nodes of one element in page order, fused by their geometric mean, and paths that reach a share of the page's
best path are content. What HTML itself names as no part of an article (menus, footers, forms, scripts, adverts and the like)
is never content. Where no article or main element holds half of the content, the ratio alone decides: paths outside the
core, the deepest element around half of the content or one around it with paragraphs beside it, must come near the best. Every block on a content path stays. Sections
add short blocks to them: the articles (or main elements) that hold content, where these hold at least half of it
together, else the lowest element around all content and the deepest one around most of it.

Names in class, id or role and form elements exclude what they hold, unless that is the page or its article: html, body,
main and article are never excluded by their own names, other elements not where they hold most of the fused ratio of
the articles (of main, of the page, where there is no article).

Pages are independent rows; nothing is shuffled.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import fresh, quoted, text_of

# Element names as HTML defines them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template".split())
ASIDE = frozenset("nav header footer aside button select option fieldset dialog menu head script style noscript iframe template svg "
                  "canvas object audio video textarea title label input math noembed noframes xmp datalist map".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q rp rt ruby s samp small span strike "
                   "strong sub sup time tt u var wbr".split())
BLOCK_IN_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
                       "h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
SCOPE = frozenset("ul ol dl table select".split())
WHOLE = frozenset("html body main article".split())
PARAGRAPH = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre".split())
# Words in class, id or role that name what is no part of an article.
NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|banner|sponsor(?:ed)?|promo(?:tion)?s?|promoted|comments?|commentlist|disqus|respond|reply|replies|"
    r"sidebar\w*|side-?bar|menu\w*|navbar|nav|navigation|breadcrumbs?|footer|site-?header|page-?header|masthead|cookies?|cookie\w*|consent|gdpr|"
    r"notices?|newsletter|subscribe|subscription|signup|social|share|sharing|related|recommended|popup|modal|pagination|pager|widget\w*|"
    r"toolbar|skip-?link|tags?|search|login|complementary|contentinfo|alert)(?:$|[\s_-])", re.I)
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
SPACE = re.compile(r"[ \t\n\r\f\v  -     　 \u0085]+")
# Latin marks end a word; those inside an address or a number are none.
MARKS = re.compile(r"[.,;:!?…](?=[\s\"'»”’)\]]|$)|[。、，！？；：]")
SMOOTH = (0.25, 0.5, 0.25)
SHARE = 0.2          # of the best fused ratio that a path must reach
APART = 0.9          # the same for paths outside the core of the content
HOLDS = 0.5          # of the content that a section must hold
MOST = 0.8           # of the content that an element must hold to count as a section without article or main


class Node:
    __slots__ = ("tag", "label", "parent", "out", "link", "number", "named", "place", "spared")

    def __init__(self, tag: str, label: str, parent: Node | None, out: bool, number: int, named: bool = False):
        self.tag, self.label, self.parent, self.out, self.number = tag, label, parent, out, number
        self.link = tag == "a" or (parent is not None and parent.link)
        # The nearest element, this one included, that its name may exclude, and whether it holds the page after all.
        self.named: Node | None = self if named else parent.named if parent is not None else None
        self.spared = False
        self.place = 2 if tag == "article" else 1 if tag == "main" else 0
        if parent is not None:
            self.place = max(self.place, parent.place)

    def names(self) -> Iterator[Node]:
        """The elements around this one that their names may exclude."""
        node = self.named
        while node is not None:
            yield node
            node = node.parent.named if node.parent is not None else None

    def excluded(self) -> bool:
        return self.out or any(not n.spared for n in self.names())

    def path(self) -> str:
        parts, node = [], self
        while node is not None:
            parts.append(node.label)
            node = node.parent
        return "/".join(reversed(parts))


class Block:
    """Text between two block borders: its pieces, and the element that holds it."""

    __slots__ = ("node", "text", "linked", "path")

    def __init__(self, node: Node):
        self.node, self.text, self.linked, self.path = node, [], 0, ""


def _attributes(text: str) -> tuple[str, bool, bool]:
    """(name for the path, whether the element is hidden, whether its name is that of no part of an article)."""
    label, out, named = "", False, False
    for name, value in ATTRIBUTE.findall(text):
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id", "role"):
            if name == "class":
                label = "." + " ".join(sorted(value.split()))
            named = named or bool(NAMES.search(value))
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            out = True
        elif name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            out = True
    return label, out, named


def blocks_of(page: str) -> list[Block]:
    """Blocks of text in page order; inline elements stay inside their block, unclosed elements end as HTML ends them."""
    root = Node("#root", "", None, False, 0)
    node, made, current = root, 1, None
    out: list[Block] = []

    def holder(n: Node) -> Node:
        while n.tag in INLINE and n.parent is not None:
            n = n.parent
        return n

    def add(text: str) -> None:
        nonlocal current
        if not text:
            return
        if current is None:
            current = Block(holder(node))
            out.append(current)
        current.text.append((text, node))
        if node.link:
            current.linked += len(text.strip())

    at, size = 0, len(page)
    while at < size:
        found = TOKEN.search(page, at)
        if found is None:
            add(page[at:])
            break
        add(page[at:found.start()])
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            if found[0].startswith("<![CDATA["):
                add(html.escape(found[0][9:].removesuffix("]]>"), quote=False))
            continue
        if found[1]:
            if tag == "br":
                current = None
                continue
            mark = node
            while mark is not None and mark.tag != tag:
                mark = mark.parent if not (tag in INLINE and mark.tag not in INLINE) else None
            if mark is not None and mark.parent is not None:
                node = mark.parent
                if tag not in INLINE:
                    current = None
            elif tag == "p":
                current = None
            continue
        if tag in BLOCK_IN_P or tag in CLOSES:
            current = None
            mark = node
            while mark.parent is not None and (mark.tag in INLINE or mark.tag == "p"):
                if mark.tag == "p" and tag in BLOCK_IN_P:
                    node = mark.parent
                mark = mark.parent
            closing = CLOSES.get(tag)
            if closing:
                mark = node
                while mark.parent is not None and mark.tag not in SCOPE:
                    if mark.tag in closing:
                        node = mark.parent
                    mark = mark.parent
        if tag in VOID:
            if tag == "br" or tag not in INLINE and tag not in ("img", "input", "embed"):
                current = None
            continue
        label, hidden, named = _attributes(found[3]) if found[3] else ("", False, False)
        if tag not in INLINE:
            current = None
        child = Node(tag, tag + label, node, node.out or hidden or tag in ASIDE, made, tag == "form" or named and tag not in WHOLE)
        made += 1
        if found[3].rstrip().endswith("/") and tag in ("svg", "math", "path"):
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else size
            continue
        node = child
    return out


def _clean(pieces: list[tuple[str, Node]]) -> str:
    return SPACE.sub(" ", html.unescape("".join(text for text, node in pieces if not node.excluded()))).strip(" ")


def _smooth(values: np.ndarray, parents: list[Node | None]) -> np.ndarray:
    """Weighted means with the blocks before and after; an element's first and last block count twice instead."""
    near = np.array([x is y for x, y in zip(parents[:-1], parents[1:], strict=True)], bool)
    before, after = values.copy(), values.copy()
    before[1:][near] = values[:-1][near]
    after[:-1][near] = values[1:][near]
    return SMOOTH[0] * before + SMOOTH[1] * values + SMOOTH[2] * after


def _ratios(blocks: list[Block], texts: list[str]) -> tuple[np.ndarray, dict[str, list[int]]]:
    """Fused ratio of each block, and (characters outside links, marks, blocks) per path."""
    sums: dict[str, list[int]] = defaultdict(lambda: [0, 0, 0])
    for b, text in zip(blocks, texts, strict=True):
        s = sums[b.path]
        s[0] += max(0, len(text) - b.linked)
        s[1] += len(MARKS.findall(text))
        s[2] += 1
    ratio = np.array([[sums[b.path][0] / sums[b.path][2], (sums[b.path][1] + 0.1) / sums[b.path][2]] for b in blocks]).reshape(-1, 2)
    parents = [b.node.parent for b in blocks]
    return np.sqrt(_smooth(ratio[:, 0], parents) * _smooth(ratio[:, 1], parents)), sums


def path_levels(blocks: list[Block], texts: list[str]) -> dict[str, float]:
    """The largest fused ratio of a path's blocks, as a share of the page's largest; paths of links alone have 0."""
    fused, sums = _ratios(blocks, texts)
    level: dict[str, float] = defaultdict(float)
    for b, f in zip(blocks, fused, strict=True):
        if sums[b.path][0]:
            level[b.path] = max(level[b.path], float(f))
    top = max(level.values(), default=0.0)
    return {b.path: level[b.path] / top if top > 0 else 0.0 for b in blocks}


def _readable(every: list[Block]) -> tuple[list[Block], list[str]]:
    """The blocks that are not excluded and have text, and their texts."""
    blocks, texts = [], []
    for b in every:
        if b.node.excluded():
            continue
        text = _clean(b.text)
        if text:
            b.path = b.path or b.node.path()
            blocks.append(b)
            texts.append(text)
    return blocks, texts


def _spare(every: list[Block]) -> None:
    """Marks the named elements that hold most of the fused ratio, as if no name excluded anything."""
    named = {n.number: n for b in every for _, node in b.text for n in node.names()}
    if not named:
        return
    for n in named.values():
        n.spared = True
    blocks, texts = _readable(every)
    held: list[dict[int, float]] = [defaultdict(float) for _ in range(3)]
    total = [0.0] * 3
    for b, f in zip(blocks, _ratios(blocks, texts)[0] if blocks else (), strict=True):
        pieces = [(len(text.strip()), node) for text, node in b.text if not node.excluded()]
        size = max(1, sum(n for n, _ in pieces))
        for length, node in pieces:
            for place in range(node.place + 1):
                total[place] += f * length / size
                for n in node.names():
                    held[place][n.number] += f * length / size
    place = max((k for k in range(3) if total[k] > 0), default=0)
    for n in named.values():
        n.spared = held[place][n.number] > HOLDS * total[place]


def main_text(page: str) -> tuple[str, list[str]]:
    """(text, paths of its nodes) of a page; empty for a page without content."""
    every = blocks_of(page)
    _spare(every)
    blocks, texts = _readable(every)
    if not blocks:
        return "", []
    level = path_levels(blocks, texts)
    content = [level[b.path] >= SHARE for b in blocks]
    if not any(content):
        content = [True] * len(blocks)
    sections, around = _sections(blocks, texts, content)
    if not any(n.tag in ("article", "main") for n in sections):
        core = _core(blocks, texts, content)
        if core is not None:
            content = [c and (level[b.path] >= APART or _under(b.node, core)) for b, c in zip(blocks, content, strict=True)]
            sections, around = _sections(blocks, texts, content)
    content = [c or any(_under(b.node, s) for s in sections) or around is not None and 2 * b.linked < len(text) and _under(b.node, around)
               for b, text, c in zip(blocks, texts, content, strict=True)]
    kept = [(t, b.path) for t, b, c in zip(texts, blocks, content, strict=True) if c]
    return "\n\n".join(t for t, _ in kept), sorted({p for _, p in kept})


def _under(node: Node | None, section: Node) -> bool:
    while node is not None:
        if node is section:
            return True
        node = node.parent
    return False


class _Weights:
    """Characters of content below each element."""

    def __init__(self):
        self.total, self.below, self.nodes, self.depth = 0, defaultdict(int), {}, {}

    def add(self, node: Node | None, size: int) -> None:
        chain = []
        while node is not None:
            chain.append(node)
            node = node.parent
        self.total += size
        for d, n in enumerate(reversed(chain)):
            self.below[n.number] += size
            self.nodes[n.number], self.depth[n.number] = n, d

    def deepest(self, share: float) -> Node | None:
        """The deepest element, but for the page itself and paragraphs, that holds this share."""
        held = [n for n in self.nodes.values()
                if self.below[n.number] >= share * self.total and n.tag not in ("#root", "html", "body", "p")]
        return max(held, key=lambda n: self.depth[n.number], default=None)


def _weighed(blocks: list[Block], texts: list[str], content: list[bool]) -> _Weights:
    weights = _Weights()
    for b, text, c in zip(blocks, texts, content, strict=True):
        if c:
            weights.add(b.node, len(text))
    return weights


def _core(blocks: list[Block], texts: list[str], content: list[bool]) -> Node | None:
    """The deepest element around half of the content, or the outermost one around it that has paragraphs of its own."""
    core = node = _weighed(blocks, texts, content).deepest(HOLDS)
    beside = {b.node.parent.number for b, c in zip(blocks, content, strict=True) if c and b.node.tag in PARAGRAPH and b.node.parent is not None}
    while node is not None and node.tag not in ("#root", "html", "body"):
        if node.number in beside:
            core = node
        node = node.parent
    return core


def _sections(blocks: list[Block], texts: list[str], content: list[bool]) -> tuple[list[Node], Node | None]:
    """(elements whose blocks all belong to the content, element whose blocks do unless they are mostly links)."""
    weights = _weighed(blocks, texts, content)
    inside = {"article": 0, "main": 0}
    for b, text, c in zip(blocks, texts, content, strict=True):
        for tag in inside if c else ():
            inside[tag] += len(text) if _within(b.node, tag) else 0
    for tag in inside:
        if inside[tag] and inside[tag] >= HOLDS * weights.total:
            return [n for n in weights.nodes.values() if n.tag == tag], None
    most = weights.deepest(MOST)
    return [most] if most is not None else [], weights.deepest(1.0)


def _within(node: Node | None, tag: str) -> bool:
    while node is not None and node.tag != tag:
        node = node.parent
    return node is not None


def _extractor(carry: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [main_text(x.as_py()) for x in batch.column(carry)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in range(carry)], pa.array([t for t, _ in done], pa.string()),
                 pa.array([p for _, p in done], pa.list_(pa.string()))], names=[*batch.schema.names[:carry], "text", "paths"])
    return run


def extract(pages: DataFrame, markup: str = "html", carry: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """(carry..., text, paths) per row: the main text, blocks joined by two line ends, and the tag paths it came from.

    A missing or empty page, and one without any text, has an empty text. Broken markup is read as far as it goes.
    Repeated rows stay repeated; an empty table gives an empty frame.
    """
    (name,) = fresh(pages, "markup")
    rows = pages.select(*[F.col(quoted(c)) for c in carry], text_of(markup).alias(name))
    kinds = ", ".join(f"{quoted(c)} {pages.schema[c].dataType.simpleString()}" for c in carry)
    return rows.mapInArrow(_extractor(len(carry)), f"{kinds}, text string, paths array<string>")
