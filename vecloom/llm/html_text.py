"""Main text of HTML pages by minimum-cut labelling.

A page becomes a sequence of text blocks with their place in the element tree.  A linear
classifier prices both labels of each block; the price difference is the capacity of its
edge to the content or the boilerplate terminal.  Neighbouring blocks, and blocks near
each other in the tree, are joined by smoothness edges.  The minimum cut, found by
maximum flow, is the cheapest labelling.

Blocks whose terminal capacity exceeds all their smoothness edges together keep that side
in every minimum cut; they are fixed first and their edges turned into terminal
capacity, which leaves few blocks for the flow.

The costs are fixed and stated in :class:`Costs`; pages carry no labels to learn from.

Defined results: a null page has an empty text.  Character references are decoded, white
space inside a block becomes one space, and blocks are joined by line feeds.  Tags that
are never closed end with the element around them; a head ends at the first text or element
that cannot stand in it.  What a wrapper's name says of its content (or a form around it)
does not hold inside a main or article element in it, unless that is inside another article,
or the name is one of secondary articles (comments, related, sidebar).  A page without any content block has
an empty text.  Result columns replace input columns of the same name.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecloom.llm.common import text_slices, without

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<name>[A-Za-z][A-Za-z0-9:-]*)(?P<attrs>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[!?][^<>]*>"
    r"|<(?P<end2>/?)(?P<name2>[A-Za-z][A-Za-z0-9:-]*)[^<>]*>",
    re.S,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_TOKEN = re.compile(r"[a-z0-9]+")
# In a name such as "page-with-sidebar" what follows tells what the element has, not what it is.
_MODIFIED = re.compile(r"(?:(?<=[-_])|(?<!\S))(?:has|with|without|no)[-_]\S*")

# Kinds of elements.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q s samp small span strike strong "
    "sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp".split())  # their content is no markup
UNSEEN = frozenset("head script style textarea title xmp noscript template iframe object svg canvas audio video select option button".split())
HEAD = frozenset("html head base basefont bgsound link meta title style script noscript noframes template".split())  # do not end a head
BOILERPLATE = frozenset("nav footer aside form menu dialog fieldset".split())
CLOSES_ITSELF = {
    "li": "ul ol menu", "dt": "dl", "dd": "dl", "tr": "table tbody thead tfoot", "td": "tr table", "th": "tr table", "option": "select",
}
# Words in classes, ids and roles.
BOILERPLATE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising alert aside author banner bottombar breadcrumb breadcrumbs bio byline comment comments "
    "complementary consent contentinfo cookie cookies copyright dialog disclaimer disqus footer gdpr legal login menu masthead modal nav navbar "
    "navigation newsletter notice notification overlay pager pagination popup promo promotion recommended related reply replies respond search "
    "share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar topbar widget".split()
)
# Named like these, an element holds secondary articles; any other name may be that of a wrapper around the page's own.
SECONDARY_WORDS = frozenset("comment comments disqus recommended related replies reply respond".split())
SECONDARY_NAMES = frozenset("sidebar widget".split())  # as a whole name only
HEADER_WORDS = frozenset("header topbar masthead banner".split())
CONTENT_WORDS = frozenset("article content entry main post story".split())


@dataclass(frozen=True)
class Costs:
    """Weights of the classifier (positive: content) and of the smoothness edges."""

    bias: float = -1.0
    article: float = 4.0  # inside article, main or role=main
    content_word: float = 1.5  # inside an element named like content
    boilerplate: float = -12.0  # inside an element that is or is named like boilerplate
    page_header: float = -6.0  # inside a header outside the article
    links: float = -4.0  # times the share of characters inside links
    words: float = 0.6  # times log(1 + words)
    ended: float = 0.5  # ends like a sentence
    paragraph: float = 0.5
    next_block: float = 0.8  # smoothness, divided by one plus the steps between the blocks' parents
    same_parent: float = 0.6  # smoothness between a block and the next one of the same parent


@dataclass
class Block:
    text: str
    tag: str
    path: tuple[int, ...]  # numbers of the elements around it, outermost first
    article: bool
    content_word: bool
    boilerplate: bool
    header: bool
    links: float


@dataclass
class _Element:
    tag: str
    number: int
    unseen: bool = False
    article: bool = False
    content_word: bool = False
    boilerplate: bool = False
    header: bool = False
    link: bool = False
    wrapped: bool = False  # boilerplate, but only by wrappers that an article or main inside undoes
    wrapped_header: bool = False
    secondary: bool = False  # inside a wrapper named like secondary articles
    nested: bool = False  # inside an article element


@dataclass
class _Reader:
    stack: list[_Element] = field(default_factory=lambda: [_Element("", 0)])
    blocks: list[Block] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    count: int = 0

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            around = [e for e in self.stack if e.tag not in INLINE]
            top = self.stack[-1]
            self.blocks.append(Block(
                text, around[-1].tag, tuple(e.number for e in around), top.article, top.content_word, top.boilerplate or top.wrapped,
                top.header or top.wrapped_header, min(1.0, self.linked / len(text)),
            ))
        self.parts, self.linked = [], 0

    def text(self, raw: str) -> None:
        if self.stack[-1].tag == "head" and not raw.isspace() and raw:
            self.pop_to(len(self.stack) - 1)
        top = self.stack[-1]
        if raw and not top.unseen:
            raw = html.unescape(raw) if "&" in raw else raw
            self.parts.append(raw)
            if top.link:
                self.linked += len(raw.strip())

    def pop_to(self, depth: int) -> None:
        del self.stack[depth:]

    def end_head(self, tag: str) -> None:
        """An element that cannot stand in a head ends it; body does so even if something is still open inside."""
        if tag == "body":
            for depth in range(len(self.stack) - 1, 0, -1):
                if self.stack[depth].tag == "head":
                    self.pop_to(depth)
                    return
                if self.stack[depth].tag == "body":
                    return
        elif tag not in HEAD and self.stack[-1].tag == "head":
            self.pop_to(len(self.stack) - 1)

    def open(self, tag: str, attributes: str) -> None:
        self.end_head(tag)
        if tag not in INLINE:
            self.flush()
            if tag in CLOSES_ITSELF:
                borders = CLOSES_ITSELF[tag].split()
                for depth in range(len(self.stack) - 1, 0, -1):
                    if self.stack[depth].tag in borders:
                        break
                    if self.stack[depth].tag == tag:
                        self.pop_to(depth)
                        break
            # A block element ends the paragraph it starts in, with all that is open inside.
            for depth in range(len(self.stack) - 1, 0, -1):
                if self.stack[depth].tag == "p":
                    self.pop_to(depth)
                    break
                if self.stack[depth].tag not in INLINE:
                    break
        elif tag == "br":
            self.parts.append(" ")
        if tag in VOID:
            return
        up = self.stack[-1]
        self.count += 1
        new = _Element(
            tag, self.count, up.unseen or tag in UNSEEN, up.article, up.content_word, up.boilerplate, up.header, up.link or tag == "a",
            up.wrapped, up.wrapped_header, up.secondary, up.nested or up.tag == "article",
        )
        words: set[str] = set()
        named: set[str] = set()
        secondary = role_main = False
        if attributes and tag not in ("html", "body"):
            for attribute, value in _ATTRIBUTE.findall(attributes):
                value = value.strip("\"'").lower()
                words.update(_TOKEN.findall(value))
                named.update(_TOKEN.findall(_MODIFIED.sub(" ", value)))
                secondary |= not SECONDARY_NAMES.isdisjoint(value.split())
                if attribute.lower() == "role":
                    role_main |= value.strip() == "main"
                    secondary |= value.strip() in BOILERPLATE_WORDS
        if tag in ("article", "main") or "main" in words and tag not in INLINE:
            new.article = True
            one = tag == "main" or role_main  # a page has only one
            if not new.nested and (one or tag == "article" and not new.secondary):
                new.wrapped = new.wrapped_header = new.secondary = False
        elif tag not in INLINE:
            new.content_word |= bool(words & CONTENT_WORDS)
            secondary |= bool(named & SECONDARY_WORDS)
            by_name = bool(named & BOILERPLATE_WORDS - HEADER_WORDS)
            # A header inside the article holds its title.
            new.header |= not up.article and tag == "header"
            new.wrapped_header |= not up.article and bool(named & (HEADER_WORDS | {"header"}))
            # Some pages stand in one form as a whole.
            new.boilerplate |= tag in BOILERPLATE and tag != "form"
            new.wrapped |= tag == "form" or by_name
            new.secondary |= secondary
        self.stack.append(new)

    def close(self, tag: str) -> None:
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth].tag == tag:
                if tag not in INLINE or any(e.tag not in INLINE for e in self.stack[depth:]):
                    if tag in INLINE:
                        return  # an inline end tag does not end blocks
                    self.flush()
                self.pop_to(depth)
                return
        if tag not in INLINE:
            self.flush()


def read_blocks(page: str) -> list[Block]:
    """All visible text of a page, block by block."""
    reader, at = _Reader(), 0
    for m in iter(lambda: _TAG.search(page, at), None):
        reader.text(page[at:m.start()])
        at = m.end()
        name = m["name"] or m["name2"]
        if not name:
            continue
        name = name.lower()
        if m["end"] or m["end2"]:
            reader.close(name)
            continue
        reader.open(name, m["attrs"] or "")
        if name in RAW:
            end = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
            at = end.start() if end else len(page)
    reader.text(page[at:])
    reader.flush()
    return reader.blocks


def score(block: Block, c: Costs) -> float:
    """Log-odds that a block is content."""
    return (
        c.bias + c.article * block.article + c.content_word * block.content_word + c.boilerplate * block.boilerplate
        + c.page_header * block.header + c.links * block.links + c.words * math.log1p(block.text.count(" ") + 1)
        + c.ended * (block.text[-1] in ".!?…\"”»") + c.paragraph * (block.tag == "p")
    )


def smoothness(blocks: list[Block], c: Costs) -> list[tuple[int, int, float]]:
    """Edges between blocks that are next to each other or close in the tree."""
    edges = []
    last_of: dict[int, int] = {}
    for i, block in enumerate(blocks):
        if i:
            before, common = blocks[i - 1].path, 0
            for a, b in zip(before, block.path, strict=False):
                if a != b:
                    break
                common += 1
            steps = len(before) + len(block.path) - 2 * common
            edges.append((i - 1, i, c.next_block / (1 + steps / 2)))
        parent = block.path[-2] if len(block.path) > 1 else 0
        if parent in last_of:
            edges.append((last_of[parent], i, c.same_parent))
        last_of[parent] = i
    return edges


def minimum_cut(scores: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay with the content terminal in a cheapest cut."""
    near: list[dict[int, float]] = [{} for _ in scores]
    for i, j, w in edges:
        if i != j:
            near[i][j] = near[i].get(j, 0.0) + w
            near[j][i] = near[j].get(i, 0.0) + w
    terminal, side = list(scores), [False] * len(scores)
    left = set(range(len(scores)))
    todo = deque(range(len(scores)))
    while todo:
        i = todo.popleft()
        if i in left and abs(terminal[i]) > sum(near[i].values()):
            left.discard(i)
            side[i] = terminal[i] > 0
            for j, w in near[i].items():
                terminal[j] += w if side[i] else -w
                del near[j][i]
                todo.append(j)
            near[i] = {}
    if left:
        for i in _flow(sorted(left), terminal, near):
            side[i] = True
    return side


def _flow(nodes: list[int], terminal: list[float], near: list[dict[int, float]]) -> set[int]:
    """Maximum flow along shortest augmenting paths; the nodes the content terminal still reaches."""
    source, sink = -1, -2
    room: dict[int, dict[int, float]] = {i: dict(near[i]) for i in nodes} | {source: {}, sink: {}}
    for i in nodes:
        if terminal[i] > 0:
            room[source][i] = terminal[i]
            room[i].setdefault(source, 0.0)
        elif terminal[i] < 0:
            room[i][sink] = -terminal[i]
            room[sink][i] = 0.0
    while True:
        came, todo = {source: source}, deque([source])
        while todo and sink not in came:
            u = todo.popleft()
            for v, free in room[u].items():
                if free > 1e-12 and v not in came:
                    came[v] = u
                    todo.append(v)
        if sink not in came:
            return {v for v in came if v >= 0}
        path, v = [], sink
        while v != source:
            path.append((came[v], v))
            v = came[v]
        amount = min(room[u][v] for u, v in path)
        for u, v in path:
            room[u][v] -= amount
            room[v][u] = room[v].get(u, 0.0) + amount


def main_text(page: str | None, costs: Costs = Costs()) -> str:
    blocks = read_blocks(page or "")
    kept = minimum_cut([score(b, costs) for b in blocks], smoothness(blocks, costs))
    return "\n".join(b.text for b, keep in zip(blocks, kept, strict=True) if keep)


def extract_text(pages: DataFrame, *, page: str = "html", costs: Costs = Costs()) -> DataFrame:
    """Add ``text`` and ``n_chars`` (code points) to every page."""

    @F.arrow_udf("string")
    def extract(column: pa.Array) -> pa.Array:
        out: list[str] = []
        batch = pa.RecordBatch.from_arrays([column], names=["page"])
        for part in text_slices(batch, "page"):
            out += (main_text(p, costs) for p in _values(part.column(0)))
        return pa.array(out, type=pa.string())

    own = without(pages, "text", "n_chars")
    return own.withColumn("text", extract(pages[page])).withColumn("n_chars", F.char_length("text").cast("long"))


def _values(column: pa.Array) -> Iterator[str | None]:
    for value in column:
        yield value.as_py()
