"""HTML extraction (7): tag-path ratios.

Each text node of a page has a root-to-leaf tag path. Text length and punctuation are summed per
path and divided by its number of nodes; the two ratios are smoothed over the page's nodes with
a Gaussian, fused by their product, and paths whose fused ratio reaches a share of the page's
standard deviation are content; where a single article or main holds most of it, only what lies
in there. The container is the enclosing article or main of the lowest element that holds all
content, else that element itself, but never a quote, a table, or one of
several sections; without an ``h1`` in it, it grows to hold the title (out of an article only
within main). The container adds the neighbours of the content: nodes in it on other paths, so
that short paragraphs stay, but not lists of links, ``LINKS`` or more in a row with nothing else
between, whose paths are no content. Scripts, forms, navigation, and elements that name
themselves adverts, notices, comments or the like never count.

Time and memory grow with a page's length, however its tags are nested or left open: paths are
numbered by their parent's number and a tag, and what lies below an element is summed once from
the last element to the first.

Blocks: a block element begins a new block; white space inside a block becomes one space, blocks
are trimmed, empty ones dropped and the rest joined by an empty line.

Defined results: NULL or empty HTML gives the empty text, as does a page without content; plain
text without tags is its own content; unclosed comments and raw-text elements run to the end; a
``<`` that begins no tag is text; a tag that never ends, its quotes counted, ends at the next
``>``, and quotes no longer count after it; without one the rest is text; repeated pages are extracted alike; an empty table gives no
rows; columns named ``text`` or ``n_chars`` are replaced.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from archiveloom.llm import packing as pk

# Element names of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section "
    "summary table tbody td tfoot th thead tr ul".split()
)
BOILERPLATE = frozenset(
    "aside button dialog footer form head iframe input label menu nav noscript option script search select style svg "
    "template textarea title canvas object audio video".split()
)
# Elements whose start ends an open element of the second set.
LISTS = ("ul", "ol", "dl", "table", "select")  # an element outside of the innermost of these stays open
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
# Words of class, id and role that mark what is not the article.
MARKS = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|adv|advert\w*|banner|sponsor\w*|promo\w*|cookie\w*|consent|gdpr|notice\w*|alert|popup|modal|overlay|"
    r"newsletter|subscri\w*|nav\w*|menu\w*|breadcrumb\w*|header|footer|masthead|sidebar\w*|aside|widget\w*|related|recommend\w*|"
    r"comment\w*|disqus\w*|respond|reply|replies|share|sharing|social|login|signup|search|pagination|pager|toolbar|copyright|"
    r"complementary|contentinfo|navigation|hidden)(?=$|[\s_-])",
    re.I,
)
ATTRIBUTE = re.compile(r"""([^\s=>"'/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_DECLARED = r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|"
_TAG = r"<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attributes>%s)(?P<end>>|\Z)"
# Possessive, so that no tag is read twice; the second form is for pages with a quote left open.
TOKEN = re.compile(_DECLARED + _TAG % r"""(?>=\s*+"[^"]*+(?:"|\Z)|=\s*+'[^']*+(?:'|\Z)|[^>=]++|=)*+""", re.S)
UNQUOTED = re.compile(_DECLARED + _TAG % r"[^>]*+", re.S)
# Numbers of more digits than a character's are none; the library refuses to convert very long ones.
LONG_REFERENCE = re.compile(r"&#(?:0*+(?P<decimal>[0-9]{8,}+)|[xX]0*+(?P<hex>[0-9a-fA-F]{7,}+));?|(?<=&#)0++(?=[0-9])|(?<=&#[xX])0++(?=[0-9a-fA-F])")
SPACE = re.compile(r"[\s\xa0]+")
PUNCTUATION = re.compile(r"""[.,;:!?…。，、；：！？]""")

SMOOTH = 1.0  # width of the Gaussian, in nodes
THRESHOLD = 0.5  # standard deviations of the fused ratio
LINKS = 3  # links in a row that make a list of links


class Element:
    """An element with what it has from the elements around it."""

    __slots__ = ("name", "number", "path", "parent", "skipped", "article", "main", "h1", "link")

    def __init__(self, name: str, number: int, path: int, parent: Element | None, skipped: bool):
        self.name, self.number, self.path, self.parent, self.skipped = name, number, path, parent, skipped
        outer = parent.article if parent else None
        self.article = outer or (self if name in ARTICLES else None)  # the outermost one
        self.main = name == "main" or bool(parent and parent.main)
        self.h1 = name == "h1" or bool(parent and parent.h1)
        self.link = name == "a" or bool(parent and parent.link)


@dataclass(slots=True)
class Node:
    text: str
    element: Element
    block: int


def _marked(name: str, attributes: str, inside: Element) -> bool:
    if name in BOILERPLATE:
        return True
    if name == "header":  # an article's own header holds its title
        return inside.article is None
    for match in ATTRIBUTE.finditer(attributes):
        key = match[1].lower()
        value = match[2] or match[3] or match[4] or ""
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            return True
        if key == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return True
        if key in ("class", "id", "role") and name not in ("html", "body", "article", "main") and MARKS.search(value):
            return True
    return False


class _Open:
    """The stack of open elements, with the places of each name and of block elements."""

    def __init__(self, root: Element):
        self.stack, self.blocks = [root], [0]
        self.places: dict[str, list[int]] = {}

    def last(self, names) -> int:
        """Place of the innermost open element of these names, -1 if there is none."""
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=-1)

    def push(self, element: Element) -> None:
        self.places.setdefault(element.name, []).append(len(self.stack))
        if element.name in BLOCK:
            self.blocks.append(len(self.stack))
        self.stack.append(element)

    def close(self, place: int) -> None:
        """Closes the element at a place and all within."""
        while len(self.stack) > place:
            name = self.stack.pop().name
            self.places[name].pop()
            if name in BLOCK:
                self.blocks.pop()


def nodes_of(page: str) -> tuple[list[Node], list[Element]]:
    """Text nodes in page order with their element and block, and all elements, outer ones first."""
    root = Element("", 0, 0, None, False)
    elements, paths = [root], {}
    open_, out, block, at, end, token = _Open(root), [], 0, 0, len(page), TOKEN

    def say(text: str) -> None:
        if text:
            out.append(Node(text, open_.stack[-1], block))

    while at < end:
        match = token.search(page, at)
        if match and match["name"] and not match["end"] and token is TOKEN:
            token = UNQUOTED
            match = token.search(page, at)
        if match is None or match["name"] and not match["end"]:
            say(page[at:])
            break
        say(page[at : match.start()])
        at, name = match.end(), (match["name"] or "").lower()
        if not name:
            continue
        if match["close"]:
            if name in BLOCK:
                block += 1
            place = open_.last([name])
            # an inline end tag closes nothing outside its block
            if place > 0 and (name in BLOCK or open_.blocks[-1] < place):
                open_.close(place)
            continue
        if name == "br":
            say("\n")
            continue
        if name in BLOCK:
            block += 1
            if open_.places.get("p"):
                open_.close(open_.places["p"][-1])
            if name in CLOSES and (place := open_.last(CLOSES[name])) > open_.last(LISTS):
                open_.close(place)
        if name in VOID or (match["attributes"] or "").endswith("/") and name not in BLOCK:
            continue
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}\b[^>]*+(?:>|\Z)", re.I).search(page, at)
            at = close.end() if close else end
            continue
        up = open_.stack[-1]
        shown = name in BLOCK or name == "a"  # inline mark-up does not part paths
        path = paths.setdefault((up.path, name), len(paths) + 1) if shown else up.path
        elements.append(Element(name, len(elements), path, up, up.skipped or _marked(name, match["attributes"], up)))
        open_.push(elements[-1])
    return out, elements


def fused_ratios(nodes: list[Node]) -> np.ndarray:
    """Smoothed text ratio times smoothed punctuation ratio of each node's path."""
    _, number = np.unique([n.element.path for n in nodes], return_inverse=True)
    count = np.bincount(number)
    length = np.bincount(number, [len(n.text.strip()) for n in nodes]) / count
    marks = np.bincount(number, [len(PUNCTUATION.findall(n.text)) for n in nodes]) / count
    reach = np.arange(-3, 4)
    kernel = np.exp(-(reach**2) / (2 * SMOOTH**2))
    weight = np.convolve(np.ones(len(nodes)), kernel, "full")[3:-3]
    smooth = lambda x: np.convolve(x[number], kernel, "full")[3:-3] / weight
    return smooth(length) * (1 + smooth(marks))


def on_content_paths(nodes: list[Node]) -> list[bool]:
    """Whether each node's path is content: its best fused ratio reaches the threshold."""
    fused = fused_ratios(nodes)
    best: dict[int, float] = {}
    for node, value in zip(nodes, fused):
        best[node.element.path] = max(best.get(node.element.path, 0.0), float(value))
    limit = THRESHOLD * float(fused.std())
    return [best[n.element.path] >= limit for n in nodes]


def _chain(element: Element | None) -> Iterator[Element]:
    """The element and all around it, innermost first."""
    while element is not None:
        yield element
        element = element.parent


def _held(elements: list[Element], nodes: list[Node]) -> list[int]:
    """How many of the nodes each element holds."""
    held = [0] * len(elements)
    for node in nodes:
        held[node.element.number] += 1
    for e in reversed(elements[1:]):
        held[e.parent.number] += held[e.number]
    return held


def _container(content: list[Node], said: list[Node], elements: list[Element]) -> Element:
    """The element whose text is the main text."""
    # where one article or main holds most content, text beside it is none of the article
    outer = [n.element.article for n in content]
    if len({id(e) for e in outer if e is not None}) == 1:
        size = [len(n.text.strip()) for n in content]
        if 2 * sum(k for k, e in zip(size, outer) if e is not None) > sum(size):
            content = [n for n, e in zip(content, outer) if e is not None]
    holds = _held(elements, content)
    low = next(e for e in _chain(content[0].element) if holds[e.number] == len(content))
    around = list(_chain(low))
    after = lambda names: around[max((i + 1 for i, e in enumerate(around) if e.name in names), default=0) :]
    around = after({"blockquote"})
    articles = [e for e in around if e.name in ARTICLES]
    if articles:
        container = articles[0]
    else:
        around = after({"table", "td", "th"})
        container = next(e for e in around if e.name in CONTAINERS)
        texts, sections = _held(elements, said), {}
        for e in elements:
            if e.name == "section" and texts[e.number]:
                sections[e.parent.number] = sections.get(e.parent.number, 0) + 1
        while container.name == "section" and sections.get(container.parent.number, 0) > 1:
            container = next(e for e in _chain(container.parent) if e.name in CONTAINERS)
    titles = _held(elements, [n for n in said if n.element.h1])
    titled = next((e for e in _chain(container) if titles[e.number]), container)
    return container if container.name in ARTICLES and not titled.main else titled


def _lists_of_links(blocks: dict[int, list[tuple[Node, bool]]]) -> set[int]:
    """Blocks of ``LINKS`` or more links in a row, off content paths and without punctuation."""
    found, run, links = set(), [], 0
    for block, nodes in [*blocks.items(), (-1, [])]:
        worded = [(n, good) for n, good in nodes if any(c.isalnum() for c in n.text)]
        if worded and all(n.element.link and not good and not PUNCTUATION.search(n.text) for n, good in worded):
            run.append(block)
            links += len(worded)
        elif worded or block < 0:
            if links >= LINKS:
                found.update(run)
            run, links = [], 0
    return found


def _reference(match: re.Match) -> str:
    """Leading zeros of a character reference go; one beyond all characters becomes U+FFFD."""
    return "&#xFFFD;" if match["decimal"] or match["hex"] else ""


def main_text(page: str | None) -> str:
    """The article of one page; see the module's description."""
    nodes, elements = nodes_of(page or "")
    nodes = [n for n in nodes if not n.element.skipped]
    said = [n for n in nodes if n.text.strip()]
    if not said:
        return ""
    good = on_content_paths(said)
    container = _container([n for n, g in zip(said, good) if g], said, elements)
    inside = [False] * len(elements)
    for e in elements:
        inside[e.number] = e is container or e.parent is not None and inside[e.parent.number]
    content = {id(n) for n, g in zip(said, good) if g}
    blocks: dict[int, list[tuple[Node, bool]]] = {}
    for node in nodes:
        if inside[node.element.number]:
            blocks.setdefault(node.block, []).append((node, id(node) in content))
    dropped = _lists_of_links(blocks)
    texts = []
    for block, parts in blocks.items():
        if block not in dropped:
            text = "".join(n.text for n, _ in parts)
            if "&#" in text:
                text = LONG_REFERENCE.sub(_reference, text)
            texts.append(SPACE.sub(" ", html.unescape(text)).strip())
    return "\n\n".join(t for t in texts if t)


# Elements that can hold an article; a paragraph, a quote or a table cell is part of one.
ARTICLES = frozenset(["article", "main"])
CONTAINERS = ARTICLES | frozenset(["", "html", "body", "section", "div", "center"])


def extracted(pages: DataFrame, keep: list[str] | None = None, page: str = "html") -> DataFrame:
    """Columns ``keep`` (default: all) of ``pages`` with ``text`` and ``n_chars`` (code points)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    keep = [c for c in (keep or pages.columns) if c not in ("text", "n_chars")]
    pk.small_batches(pages.sparkSession)
    rows = pages.select(*dict.fromkeys([*keep, page]))
    out = T.StructType([*(rows.schema[c] for c in keep), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    schema = to_arrow_schema(out)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                texts = [main_text(p) for p in part.column(page).to_pylist()]
                own = [part.column(c) for c in keep]
                yield pa.RecordBatch.from_arrays([*own, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], schema=schema)

    return rows.mapInArrow(extract, out)
