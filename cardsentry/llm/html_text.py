"""Main text of web pages by tag-path ratios.

A page's text blocks are aggregated by their tag path from the root: characters and punctuation
marks per block of the path. Both ratios are smoothed over neighbouring blocks in page order and
fused by their geometric mean; paths whose mean reaches half the mean of the page's text are
content. Blocks inside a region that its tag declares as furniture (menu, footer ...) or that
is hidden (the attribute, or a style without display) count as nothing, nor do those of a form
unless it holds most of the page in long text. Regions that class names, ids or roles call
comments, adverts or notices of cookies and newsletters go, unless next to nothing is left. They and other
such names (related, search ...) take a share of the ratio, and what is then too thin goes. The regions that hold the content (the
articles of the page if a third of the content's text is in them, else the siblings of content
blocks and the elements around them that are mostly content) then give all their blocks but
furniture and lists of links, so a short heading or paragraph stays with its article.

Character references are decoded, white space inside a block becomes one space, blocks are
joined by a line feed. A line break element is white space. Markup may be cut off or unbalanced;
a new block element ends an open paragraph. Null and empty html give an empty text, and so does
a page of furniture alone. Pages are read whole, one by one, so repeated rows do not matter. Only
``page_id``, ``url`` and ``html`` are read; other columns may have any name.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!?(/?)([a-zA-Z][^\s/>]*)((?:[^<>"']|"[^"]*"|'[^']*')*)>"""
                  r"""|<[!?][^>]*>""", re.S)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I).findall
_ATTRIBUTES = re.compile(r"""([^\s"'=/>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""").findall
_MAY_HIDE = re.compile("hidden|display", re.I).search
_NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I).search
_MARKS = re.compile(r"[.,;:!?…。，、！？]").findall

# HTML elements by what they do to text.
RAW = frozenset("script style textarea title noscript template iframe noframes xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark
math q ruby rp rt s samp small span strike strong sub sup time tt u var wbr""".split())
FURNITURE = frozenset("""aside button datalist dialog fieldset footer head menu nav object
optgroup option select svg canvas audio video""".split())
ARTICLE = frozenset(("article", "main"))

# Words in class names and ids of page furniture.
_FURNITURE_NAME = re.compile(r"""(?:^|[\s_-])(?:ad|ads|adv|advert\w*|sponsor\w*|promo\w*|banner\w*|nav|
navbar|navigation|menu\w*|breadcrumbs?|sidebar\w*|footer\w*|masthead|cookies?|consent|gdpr|notices?|
alert|popup|modal|overlay|newsletter|subscribe|subscription|share|sharing|social\w*|related|recommended|
comments?|commentlist|respond|replies|disqus|discussion|login|signup|search\w*|toolbar|pagination|pager|
widgets?|copyright|legal|disclaimer|contentinfo|complementary)(?=$|[\s_-])""".replace("\n", ""), re.I).search
# Those of them that leave no doubt.
_OUTSIDE_NAME = re.compile(r"""(?:^|[\s_-])(?:advert\w*|sponsor\w*|cookies?|consent|gdpr|newsletter|
comments?|commentlist|respond|replies|disqus)(?=$|[\s_-])""".replace("\n", ""), re.I).search
_LEFT = 0.1  # the least share of a page's text beside the regions that go by such names
_CONTROLS = frozenset("input label select textarea".split())
_FORM_CHARS = 100  # of a form's text for each of its controls, if it is content
_NAME_COSTS = 0.6, 0.4  # the share of its ratio that a path loses by such a name, in an article
_HEADER_NAME = re.compile(r"(?:^|[\s_-])(?:header|topbar|top-bar)(?=$|[\s_-])", re.I).search


@dataclass
class Block:
    text: str
    path: tuple[int, ...]  # numbers of the elements from the root
    tags: str  # their names, the tag path
    linked: int  # characters inside links
    heading: bool
    named: int  # the innermost element that its names declare as furniture
    outside: tuple[int, ...] = ()  # the elements whose names leave no doubt
    form: int = 0


class _Element:
    __slots__ = ("name", "number", "furniture", "article", "link", "named", "outside", "form")

    def __init__(self, name, number, furniture, article, link, named, outside=(), form=0):
        self.name, self.number, self.furniture = name, number, furniture
        self.article, self.link, self.named = article, link, named
        self.outside, self.form = outside, form


def hidden(attributes: str) -> bool:
    """Whether an element has the attribute hidden, or a style that takes it off the page."""
    if not _MAY_HIDE(attributes):
        return False
    for name, *values in _ATTRIBUTES(attributes):
        name, value = name.lower(), "".join(values)
        if name == "hidden" and value.strip().lower() != "false":
            return True
        if name == "style" and _NO_DISPLAY(entities.unescape(value)):
            return True
    return False


_ENDS_PARAGRAPH = frozenset("""address article aside blockquote center details dir div dl fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table
ul""".split())
_ENDS_SAME = frozenset("li dt dd tr td th option".split())


def blocks_of(page: str) -> tuple[list[Block], dict[int, int], dict[int, int]]:
    """Text blocks outside furniture in page order, the articles that hold each of them, and the
    number of controls of each form."""
    stack = [_Element("", 0, False, 0, False, 0)]
    found: list[Block] = []
    articles: dict[int, int] = {}
    controls: dict[int, int] = defaultdict(int)
    parts: list[str] = []
    linked = made = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text and not stack[-1].furniture:
                elements = [e for e in stack if e.name not in INLINE]
                if stack[-1].article:
                    articles[len(found)] = stack[-1].article
                found.append(Block(text, tuple(e.number for e in elements),
                                   "/".join(e.name + "!" * (e.named == e.number > 0)
                                            for e in elements), linked,
                                   elements[-1].name[:1] == "h" and elements[-1].name[1:].isdigit(),
                                   stack[-1].named, stack[-1].outside, stack[-1].form))
            parts.clear()
        linked = 0

    def pop_to(depth: int) -> None:
        flush()
        del stack[depth:]

    def say(text: str) -> None:
        nonlocal linked
        if "&" in text:
            text = entities.unescape(text)
        if stack[-1].name == "head" and text.strip():
            pop_to(len(stack) - 1)  # its end tag may be left out
        parts.append(text)
        if stack[-1].link:
            linked += len(text.strip())

    at, n = 0, len(page)
    while at < n:
        match = _TAG.search(page, at)
        if match is None:
            if "<" not in page[at:] or not re.search(r"<[/!a-zA-Z]", page[at:]):
                say(page[at:])
            else:  # an element that is cut off at the end of the page
                say(page[at:at + re.search(r"<[/!a-zA-Z]", page[at:]).start()])
            break
        if match.start() > at:
            say(page[at:match.start()])
        at = match.end()
        name = match[2] and match[2].lower()
        if not name or match[0].startswith("<!"):
            continue
        if match[1]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].name == name:
                    if name in INLINE:
                        del stack[depth]  # overlapping inline elements close one by one
                        for k in range(depth, len(stack)):
                            stack[k].link = stack[k - 1].link or stack[k].name == "a"
                    else:
                        pop_to(depth)
                    break
                if stack[depth].name in ("td", "th", "table", "article", "body") and name in INLINE:
                    break
            continue
        if name in _CONTROLS and stack[-1].form and "hidden" not in match[3].lower():
            controls[stack[-1].form] += 1
        if name == "br":
            parts.append("\n")
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(page, at)
            close = page.find(">", end.start()) if end else -1
            at = close + 1 if close >= 0 else n
            continue
        if name in VOID:
            if name == "hr":
                flush()
            continue
        if stack[-1].name == "head":
            pop_to(len(stack) - 1)
        if name not in INLINE:
            flush()
            if name in _ENDS_PARAGRAPH:
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth].name == "p":
                        pop_to(depth)
                        break
                    if stack[depth].name not in INLINE:
                        break
            elif name in _ENDS_SAME:
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth].name == name:
                        pop_to(depth)
                        break
                    if stack[depth].name in ("ul", "ol", "dl", "table", "select"):
                        break
        above = stack[-1]
        attributes = match[3]
        names = " ".join("".join(x) for x in _NAMES(attributes)) if attributes.strip() else ""
        made += 1
        furniture = (above.furniture or name in FURNITURE
                     or (name == "header" and not above.article)
                     or hidden(attributes))
        named = made if name not in ("html", "body", "article", "main") and names and (
            _FURNITURE_NAME(names) or (not above.article and _HEADER_NAME(names))) else above.named
        outside = above.outside
        if named == made and _OUTSIDE_NAME(names):
            outside = (*outside, made)
        form = above.form or (made if name == "form" else 0)
        article = made if name in ARTICLE and not furniture and not above.article else above.article
        if not attributes.rstrip().endswith("/") or name not in INLINE:
            stack.append(_Element(name, made, furniture, article, above.link or name == "a",
                                  named, outside, form))
    flush()
    return found, articles, controls


def ratios(blocks: list[Block]) -> dict[str, float]:
    """The fused and smoothed ratio of each tag path."""
    chars, marks, count = defaultdict(int), defaultdict(int), defaultdict(int)
    for block in blocks:
        chars[block.tags] += len(block.text) - block.linked
        marks[block.tags] += len(_MARKS(block.text))
        count[block.tags] += 1
    rows = [(max(0, chars[b.tags]) / count[b.tags], (marks[b.tags] + 0.5) / count[b.tags])
            for b in blocks]
    padded = [rows[0], *rows, rows[-1]] if rows else []
    total: dict[str, float] = defaultdict(float)
    for k, block in enumerate(blocks):
        text, mark = ((padded[k][i] + 2 * padded[k + 1][i] + padded[k + 2][i]) / 4 for i in (0, 1))
        total[block.tags] += math.sqrt(text * mark)
    return {path: value / count[path] for path, value in total.items()}


def _mean(blocks: list[Block], scores: dict[str, float]) -> float:
    """The mean ratio of the text that no name declares as furniture, of all if there is none."""
    plain = [b for b in blocks if not b.named] or blocks
    return sum(scores[b.tags] * len(b.text) for b in plain) / sum(len(b.text) for b in plain)


def declared(blocks: list[Block], articles: dict[int, int]) -> set[int]:
    """The elements that are furniture by their names, and not dense enough to be content.

    A name takes a share of the ratio of a path; text without punctuation has none then.
    """
    scores = ratios(blocks)
    least = 0.5 * _mean(blocks, scores)
    sums: dict[str, list[int]] = {}
    for b in blocks:
        if b.named:
            total = sums.setdefault(b.tags, [0, 0, 0])
            for k, value in enumerate((len(b.text) - b.linked, len(_MARKS(b.text)), 1)):
                total[k] += value
    dense: dict[int, int] = defaultdict(int)
    for at, b in enumerate(blocks):
        if b.named:
            chars, marks, count = sums[b.tags]
            own = math.sqrt(max(0, chars) * marks) / count
            good = min(scores[b.tags], own) * (1 - _NAME_COSTS[at in articles]) >= least and own > 0
            dense[b.named] += len(b.text) if good else -len(b.text)
    return {element for element, value in dense.items() if value < 0}


def _around(blocks: list[Block], content: set[int]) -> list[Block]:
    """Content with its siblings, and whole elements around it that are mostly content."""
    near = {number for k in content for number in blocks[k].path[-2:]}
    sums = {number: [0, 0] for number in near}
    for k, b in enumerate(blocks):
        for number, name in zip(b.path, b.tags.split("/")):
            if number in near and name not in ("", "html", "body"):
                sums[number][k in content] += len(b.text)
    whole = {number for number, (other, own) in sums.items() if own and own >= other}
    return [b for b in blocks if not near.isdisjoint(b.path[-2:]) or not whole.isdisjoint(b.path)]


def _beside(blocks: list[Block], controls: dict[int, int]) -> set[int]:
    """The places of blocks in comments, adverts, notices and forms."""
    total = sum(len(b.text) for b in blocks)
    chars: dict[int, int] = defaultdict(int)
    for b in blocks:
        for element in {*b.outside, b.form} - {0}:
            chars[element] += len(b.text) - (b.linked if element == b.form else 0)
    thin = {e for e in {b.form for b in blocks} - {0}
            if 2 * chars[e] < total or chars[e] < _FORM_CHARS * controls.get(e, 0)}
    small = {e for b in blocks for e in b.outside if total - chars[e] >= _LEFT * total}
    out = {k for k, b in enumerate(blocks) if b.form not in thin and not small.isdisjoint(b.outside)}
    if sum(len(blocks[k].text) for k in out) > (1 - _LEFT) * total:
        out = set()  # a page of comments
    return out | {k for k, b in enumerate(blocks) if b.form in thin}


def _without(blocks: list[Block], articles: dict[int, int], held: list[int]):
    """The blocks at some places, and their articles by the new places."""
    return [blocks[k] for k in held], {at: articles[k] for at, k in enumerate(held) if k in articles}


def main_text(page: str | None) -> str:
    """The article's blocks, one per line."""
    blocks, articles, controls = blocks_of(page) if page else ([], {}, {})
    if any(b.outside or b.form for b in blocks):
        beside = _beside(blocks, controls)
        around = {e for k in beside for e in blocks[k].outside[:-1]}
        blocks, articles = _without(blocks, articles,
                                    [k for k in range(len(blocks)) if k not in beside])
        for b in blocks:  # what stays around such a region only has its name for holding one
            if b.named in around:
                b.named = 0
    if blocks:
        out = declared(blocks, articles) if any(b.named for b in blocks) else ()
        held = [k for k, b in enumerate(blocks) if b.named not in out]
        blocks, articles = _without(blocks, articles, held)
    if not blocks:
        return ""
    scores = ratios(blocks)
    least = 0.5 * _mean(blocks, scores)
    content = [k for k, b in enumerate(blocks) if scores[b.tags] >= least]
    weight = [0.0, 0.0]  # of content outside articles, and in them
    for k in content:
        cost = _NAME_COSTS[k in articles] if blocks[k].named else 0
        weight[k in articles] += (1 - cost) * len(blocks[k].text)
    if articles and 2 * weight[1] >= weight[0]:
        inside = [b for k, b in enumerate(blocks) if k in articles]
    else:
        inside = _around(blocks, set(content))
    scores = ratios(inside)
    mean = sum(scores[b.tags] * len(b.text) for b in inside) / sum(len(b.text) for b in inside)
    return "\n".join(
        b.text for b in inside
        if b.linked < 0.8 * len(b.text) or b.heading or scores[b.tags] >= 0.5 * mean)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                rows = batch.slice(at, 512)
                texts = [main_text(page) for page in rows.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())],
                    ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"),
                        F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html")).mapInArrow(
        run, "page_id long, url string, text string, n_chars long")
