"""Main text of web pages by two passes over blocks.

A page is cut into blocks of text at block tags. The first pass classifies each block by its length,
its link density and its stop-word density; blocks inside elements that never hold the article
(menus, footers, forms, comments and the like) are boilerplate at once. Short blocks and those in
between stay open; the second pass gives them the label of their nearest decided neighbours.
An ``article`` or ``main`` element is evidence for the second pass only, and only if density finds
a good block in one: it settles open blocks, never a block that the first pass has decided.

Tags are scanned once from left to right and open elements are counted by name, so the time is
linear in the length of a page, whatever its markup.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from tablewright.session import ship_with_tasks

# Elements whose content is never shown as text, elements that are never part of an
# article, and elements that end a block.
SILENT = ("script", "style", "noscript", "template", "svg", "math", "iframe", "object", "select", "textarea", "canvas", "video", "audio")
OUTSIDE = ("nav", "header", "footer", "aside", "form", "button", "dialog", "menu", "fieldset", "label", "head")
BLOCKS = (
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "div", "dl", "dt", "fieldset", "figcaption", "figure",
    "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "legend", "li", "main", "nav", "ol", "p", "pre", "section",
    "summary", "table", "tbody", "td", "tfoot", "th", "thead", "title", "tr", "ul", "head", "dialog", "menu", "option",
)
EMPTY = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
# Words in class or id, and roles, of elements that are never part of an article.
NOISE = (
    "ad", "ads", "advert", "advertisement", "adverts", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies",
    "disqus", "footer", "gdpr", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "pager", "pagination",
    "popup", "promo", "related", "replies", "reply", "respond", "share", "sharing", "sidebar", "social", "sponsor", "sponsored", "subscribe", "teaser", "teasers",
    "toolbar", "widget", "alert", "discussion", "login", "signup", "copyright", "overlay",
)
# Words that also name parts of an article: with one, a block must be good by density, or a headline.
DOUBTFUL = ("header", "search", "toc", "tags", "warning")
# The only words that count for an ``article``; other words there tell what surrounds it.
NO_ARTICLE = ("ad", "ads", "advert", "advertisement", "comment", "comments", "promo", "related", "replies", "reply", "sponsored", "teaser", "teasers")
ROLES = ("navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "form", "menu", "menubar", "toolbar", "alertdialog")
# Frequent words of the supported languages.
STOP_WORDS = frozenset(
    "the of and to in is was for on that with as at by it this be are or an from not have has his her they which but "
    "der die das und ist nicht ein eine zu den von mit sich des auf für im dem als auch es an "
    "le la les de des et est un une du en que qui dans pour pas sur au avec ce il ne se "
    "el los las y del una por con para su al lo como más o pero sus".split()
)
# First pass: characters and densities.
SHORT, LONG = 25, 140
LINKS, LOW, HIGH = 0.33, 0.1, 0.2

HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
PROSE = (*HEADINGS, "p", "li", "blockquote", "pre", "dd", "dt", "td", "figcaption")

# Paragraphs and items end where their next sibling begins; such tags close one another.
_CLOSED_BY = {"p": BLOCKS, "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th", "tr"), "th": ("td", "th", "tr"), "option": ("option",)}
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_TAG_PART = re.compile(r">|=\s*[\"']")
_ATTRIBUTE = re.compile(r"(?<![^\s/\"'])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']*)))?(?=[\s/>]|$)", re.I)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_SPACE = re.compile(r"\s+")
_SILENT_END = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I) for tag in SILENT}
_BLOCK_SET, _SILENT_SET, _OUTSIDE_SET, _EMPTY_SET, _NOISE_SET = map(frozenset, (BLOCKS, SILENT, OUTSIDE, EMPTY, NOISE))
# How far an element speaks against its text.
_CLEAN, _DOUBT, _NOISY = range(3)


class Block(NamedTuple):
    text: str
    tag: str
    links: int
    outside: bool
    doubt: bool
    article: bool


def _noise(tag: str, attributes: str) -> int:
    """What the attributes of an element say about its text."""
    if tag in ("html", "body"):
        return _CLEAN
    level = _CLEAN
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name == "hidden" or name == "aria-hidden" and value.strip().lower() == "true":
            return _NOISY
        if name == "style" and _HIDDEN.search(value):
            return _NOISY
        if name == "role" and value.strip().lower() in ROLES:
            return _NOISY
        if name in ("class", "id"):
            words = _SPLIT.split(_CAMEL.sub(" ", value).lower())
            if not (_NOISE_SET if tag not in ("article", "main") else frozenset(NO_ARTICLE)).isdisjoint(words):
                return _NOISY
            if tag not in ("article", "main") and not frozenset(DOUBTFUL).isdisjoint(words):
                level = _DOUBT
    return level


def tags(page: str) -> Iterator[tuple[str, bool, str, int, int]]:
    """``(name, closing, attributes, start, end)`` of every tag; a comment or declaration has no name.

    Nothing inside a silent element is a tag; its end tag is. A tag, comment or silent element
    without an end goes to the end of the page; a quote without a partner is an ordinary character.
    """
    size = len(page)
    unpaired: set[str] = set()  # quotes that do not occur any more
    pos = 0
    while True:
        start = page.find("<", pos)
        if start < 0:
            return
        pos = start + 1
        following = page[pos : pos + 1]
        if following in ("!", "?") or following == "/" and not page[pos + 1 : pos + 2].isalpha():
            if following == "/" and page[pos + 1 : pos + 2] != ">":
                continue  # text
            mark = "-->" if page.startswith("!--", pos) else "]]>" if page.startswith("![CDATA[", pos) else ">"
            end = page.find(mark, pos + 1)
            pos = end + len(mark) if end >= 0 else size
            yield "", False, "", start, pos
            continue
        closing = following == "/"
        found = _NAME.match(page, pos + closing)
        if found is None:
            continue  # text
        name, pos = found[0].lower(), found.end()
        inner = pos
        while True:
            part = _TAG_PART.search(page, pos)
            if part is None:
                pos = after = size
                break
            if part[0] == ">":
                after, pos = part.start(), part.end()
                break
            quote, pos = part[0][-1], part.end()
            end = -1 if quote in unpaired else page.find(quote, pos)
            if end < 0:
                unpaired.add(quote)
            else:
                pos = end + 1
        attributes = page[inner:after]
        yield name, closing, attributes, start, pos
        if name in _SILENT_SET and not closing and not attributes.rstrip().endswith("/"):
            end_tag = _SILENT_END[name].search(page, pos)
            if end_tag is None:
                yield name, True, "", size, size
                return
            close = page.find(">", end_tag.end())
            pos = close + 1 if close >= 0 else size
            yield name, True, "", end_tag.start(), pos


class _Open:
    """An open block element and the inline elements open directly in it."""

    __slots__ = ("tag", "noise", "article", "inline", "counts")

    def __init__(self, tag: str, noise: int, article: bool) -> None:
        self.tag, self.noise, self.article = tag, noise, article
        self.inline: list[tuple[str, bool]] = []  # tag, noisy
        self.counts: Counter[str] = Counter()


def blocks(page: str) -> list[Block]:
    """The blocks of a page in order; white space inside a block is one space."""
    out: list[Block] = []
    stack = [_Open("", _CLEAN, False)]
    open_blocks: Counter[str] = Counter()
    parts: list[str] = []
    size = links = noisy = anchors = noisy_inline = 0

    def end_block() -> None:
        nonlocal size, links, noisy
        if size:
            text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
            if text:
                top = stack[-1]
                # Links are counted in the page's own spelling, so their share is, too.
                share = round(links / size * len(text))
                out.append(Block(text, top.tag, share, top.noise == _NOISY or noisy == size, top.noise == _DOUBT, top.article))
        parts.clear()
        size = links = noisy = 0

    def shown(text: str) -> None:
        nonlocal size, links, noisy
        length = len(text.strip())
        parts.append(text)
        size += length
        links += length if anchors else 0
        noisy += length if noisy_inline else 0

    def close_inline(block: _Open, tag: str | None) -> None:
        """Close the elements down to ``tag``, or all."""
        nonlocal anchors, noisy_inline
        while block.inline:
            name, noise = block.inline.pop()
            block.counts[name] -= 1
            anchors -= name == "a"
            noisy_inline -= noise
            if name == tag:
                break

    def close_block() -> str:
        top = stack.pop()
        close_inline(top, None)
        open_blocks[top.tag] -= 1
        return top.tag

    at = 0
    silent = False
    for tag, closing, attributes, start, end in tags(page):
        if at < start and not silent:
            shown(page[at:start])
        at = end
        silent = False
        if not tag:
            continue
        if tag in _SILENT_SET:
            silent = not closing and not attributes.rstrip().endswith("/")
            parts.append(" ")
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in _BLOCK_SET:
            end_block()
            if closing:
                if open_blocks[tag]:
                    while close_block() != tag:
                        pass
                continue
            while tag in _CLOSED_BY.get(stack[-1].tag, ()):
                close_block()
            if tag in _EMPTY_SET:
                continue
            above = stack[-1]
            article = above.article or tag in ("article", "main")
            # A header of the article itself still holds its headline.
            noise = _NOISY if tag in _OUTSIDE_SET and not (tag == "header" and above.article) else _noise(tag, attributes)
            stack.append(_Open(tag, max(above.noise, noise), article))
            open_blocks[tag] += 1
            continue
        top = stack[-1]
        if closing or tag == "a":
            # A stray end tag of an inline element does not close the blocks around it.
            if top.counts[tag]:
                close_inline(top, tag)
        if not closing and tag not in _EMPTY_SET and not attributes.rstrip().endswith("/"):
            noise = tag in _OUTSIDE_SET or _noise(tag, attributes) == _NOISY
            top.inline.append((tag, noise))
            top.counts[tag] += 1
            anchors += tag == "a"
            noisy_inline += noise
    if at < len(page) and not silent:
        shown(page[at:])
    end_block()
    return out


def first_pass(block: Block) -> str:
    """good, bad, or open: short, or between the rules."""
    if block.outside or block.tag in ("title", "head"):
        return "bad"
    size = len(block.text)
    if block.links > LINKS * size:
        return "bad"
    if size < SHORT:
        return "bad" if block.links else "open"
    words = [w for w in (word.strip(".,;:!?\"'()*#$%&|") for word in block.text.lower().split()) if w]
    density = sum(w in STOP_WORDS for w in words) / max(1, len(words))
    if density >= HIGH:
        return "good" if size >= LONG else "open"
    if density >= LOW or block.tag in PROSE and not block.links:
        return "open"
    return "bad"


def second_pass(found: list[Block], first: list[str]) -> list[str]:
    """Labels of all blocks: an open one takes that of its nearest decided neighbours.

    Blocks outside of the text (menus and the like) are no neighbours. Where the neighbours before
    and after differ, the nearer one decides and, at equal distance, a good one wins. If density
    finds good blocks in an article element, open blocks inside of one are good unless both
    neighbours are bad, and those outside of it are bad. On a page where no block of the text is
    decided, paragraphs, items and headings are the text, as is all of an article element.
    """
    marked = any(b.article and label == "good" for b, label in zip(found, first))
    decided = [label if label != "open" and not b.outside and b.tag not in ("title", "head") else "" for b, label in zip(found, first)]
    after: list[tuple[str, int]] = [("", 0)] * len(found)
    near = ("", 0)
    for i in range(len(found) - 1, -1, -1):
        after[i] = near
        if decided[i]:
            near = (decided[i], i)
    labels = []
    last = ("", 0)
    for i, (block, label) in enumerate(zip(found, first)):
        if label == "open":
            around = {last[0], after[i][0]} - {""}
            if block.doubt and block.tag not in HEADINGS or marked and not block.article:
                label = "bad"
            elif not around:
                label = "good" if block.article or block.tag in PROSE else "bad"
            elif marked:
                label = "bad" if last[0] == after[i][0] == "bad" else "good"
            elif len(around) == 1:
                label = around.pop()
            else:
                before, behind = i - last[1], after[i][1] - i
                label = "good" if before == behind else last[0] if before < behind else after[i][0]
        labels.append(label)
        if decided[i]:
            last = (decided[i], i)
    return labels


def main_text(page: str | None) -> str:
    """The good blocks of both passes, joined by line feeds; empty if there is none."""
    found = blocks(page or "")
    labels = second_pass(found, [first_pass(b) for b in found])
    return "\n".join(b.text for b, label in zip(found, labels) if label == "good")


def extract(pages: DataFrame, content: str = "html") -> DataFrame:
    """Replace ``content`` by ``text`` and ``n_chars`` (code points); other columns stay.

    A null or empty page has an empty text. Pages are taken whole; nothing is shuffled.
    """
    names = [c for c in pages.columns if c not in (content, "text", "n_chars")]
    schema = [*(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select(*names).schema), "text string", "n_chars long"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [main_text(page) for page in part.column(len(names)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(names)], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*names, "text", "n_chars"])

    return pages.select(*names, content).mapInArrow(run, ", ".join(schema))


ship_with_tasks(__name__)
