"""Main text of web pages: parser events, text-to-tag ratios, smoothing, threshold clustering."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from plumbline.llm.common import column, slices

_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav noscript ol option p pre section "
    "summary table tbody td tfoot th thead title tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Never part of an article, wherever they stand.
_DROPPED = frozenset(
    "head title script style noscript template nav aside footer form button select textarea iframe svg "
    "object canvas dialog menu audio video".split()
)
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar form".split())
#: Words of a class or id that mark what is not the article.
_MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments "
    "consent cookie cookies disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice "
    "notices overlay pagination popup promo promoted promotion related reply replies respond share sharing sidebar "
    "signup skyscraper social sponsor sponsored subscribe subscription teaser toolbar widget".split()
)
#: Those that inside an article may also name its subject; there the clustering decides.
_UNSURE = frozenset("login menu related reply replies respond share sharing social teaser toolbar widget".split())
#: Marks and tags of a page's head, which inside an article hold its own heading.
_HEADS = frozenset(["header", "heading"])
_CLOSES_SAME = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
#: Blocks that may hold a whole article on a page without marks; the page itself has no tag.
_CONTAINERS = frozenset(["", *"body center div html section td".split()])
#: Blocks that hold lists of links, where their text is mostly that.
_LISTS = frozenset("div dl ol section table ul".split())
_WORDS = re.compile(r"[a-z]+")
_MARKED_SECTION = re.compile(r"<!\[[^>]*>?")
#: Gaussian weights of a line and its neighbours, and how they are cut off.
SIGMA, RADIUS = 1.0, 2


class _Block:
    """A block tag of a page: its place in the tree, and what it is part of."""

    __slots__ = ("article", "dropped", "main", "number", "parent", "tag", "unsure")

    def __init__(self, tag: str, number: int, parent: _Block | None, dropped: bool, unsure: bool):
        self.tag, self.number, self.parent, self.dropped = tag, number, parent, dropped
        self.main = number if tag == "main" else parent.main if parent else -1
        # The outermost article, and the outermost block inside one whose mark is unsure.
        self.article = parent.article if parent and parent.article >= 0 else number if tag == "article" else -1
        self.unsure = parent.unsure if parent and parent.unsure >= 0 else number if unsure else -1


class _Line:
    __slots__ = ("block", "linked", "tags", "text")

    def __init__(self, text: str, tags: int, linked: int, block: _Block):
        self.text, self.tags, self.linked, self.block = text, tags, linked, block


class _Lines(HTMLParser):
    """Cuts a page into lines, one for each stretch of text between block tags. Memory grows with tags, not with depth."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[_Line] = []
        self.blocks = [_Block("", 0, None, False, False)]
        self.open: list[tuple[str, _Block]] = []
        self.standing: dict[str, int] = {}  # open tags by name
        self.parts: list[str] = []
        self.tags = self.linked = 0

    @property
    def block(self) -> _Block:
        return self.open[-1][1] if self.open else self.blocks[0]

    def cut(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append(_Line(text, max(self.tags, 1), self.linked, self.block))
            self.tags = 0
        self.parts, self.linked = [], 0

    def leave(self, at: int) -> None:
        for tag, _ in self.open[at:]:
            self.standing[tag] -= 1
        del self.open[at:]

    def handle_starttag(self, tag, attrs):
        if tag in _BLOCK:
            self.cut()
            shut = _CLOSES_SAME.get(tag, ()) if tag != "p" else {"p"}
            if tag not in _CLOSES_SAME:
                shut = {"p"}
            if any(self.standing.get(name) for name in shut):
                for at in range(len(self.open) - 1, -1, -1):
                    name = self.open[at][0]
                    if name in shut:
                        self.leave(at)
                        break
                    if name in _BLOCK and not (name == "p" and tag in _CLOSES_SAME):
                        break
        elif tag == "br":
            self.parts.append("\n")
        self.tags += 1
        if tag in _VOID:
            return
        block = self.block
        dropped, unsure = self.unwanted(tag, attrs)
        if tag in _BLOCK or tag in _DROPPED or dropped or unsure:
            block = _Block(tag, len(self.blocks), block, block.dropped or dropped, unsure)
            self.blocks.append(block)
        self.open.append((tag, block))
        self.standing[tag] = self.standing.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID and tag not in _BLOCK:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in _BLOCK:
            self.cut()
        self.tags += 1
        if not self.standing.get(tag):
            return
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag:
                self.leave(at)
                break
            if tag not in _BLOCK and self.open[at][0] in _BLOCK:
                break

    def handle_data(self, data):
        self.parts.append(data)
        if self.standing.get("a"):
            self.linked += len(data)

    def unwanted(self, tag: str, attrs: list) -> tuple[bool, bool]:
        """Whether a tag is none of the article, and whether it may be."""
        if tag in _DROPPED:
            return True, False
        block = self.block
        inside = block.article >= 0 or block.main >= 0
        if tag == "header":
            return not inside, False
        if tag in ("html", "body", "main"):
            return False, False
        unsure = False
        for name, value in attrs:
            if name == "hidden" or name == "aria-hidden" and value == "true":
                return True, False
            if name == "role" and value and value.lower() in _ROLES:
                return True, False
            if name in ("class", "id") and value:
                words = set(_WORDS.findall(value.lower()))
                marks = words & _MARKS
                if marks - _UNSURE or marks and not inside or words & _HEADS and not inside and "article" not in words:
                    return True, False
                unsure |= bool(marks)
        return False, unsure


def _smooth(ratios: np.ndarray) -> np.ndarray:
    weights = np.exp(-(np.arange(-RADIUS, RADIUS + 1) ** 2) / (2 * SIGMA**2))
    return np.convolve(np.pad(ratios, RADIUS, mode="edge"), weights / weights.sum(), mode="valid")


def content_lines(lines: list[_Line]) -> np.ndarray:
    """Marks the lines whose smoothed text-to-tag ratio lies in the upper of two clusters, by its logarithm.

    If any line has a ratio above zero, the one with the highest is among them.
    """
    ratios = np.array([0.0 if x.block.dropped else max(0, len(x.text) - 2 * x.linked) / x.tags for x in lines])
    if not ratios.any():
        return np.zeros(len(lines), bool)
    smooth = np.log1p(_smooth(ratios))
    low, high = smooth.min(), smooth.max()
    for _ in range(20):  # two means on a line
        cut = (low + high) / 2
        upper = smooth >= cut
        if upper.all() or not upper.any():
            break
        lower_mean, upper_mean = smooth[~upper].mean(), smooth[upper].mean()
        if (lower_mean, upper_mean) == (low, high):
            break
        low, high = lower_mean, upper_mean
    content = (smooth >= (low + high) / 2) & (ratios > 0)
    content[ratios.argmax()] = True
    return content


def _sums(blocks: list[_Block], own: dict[int, int]) -> np.ndarray:
    """For each block the sum over itself and all blocks inside it."""
    total = np.zeros(len(blocks), np.int64)
    for number, n in own.items():
        total[number] = n
    for block in reversed(blocks[1:]):  # a block comes behind those around it
        total[block.parent.number] += total[block.number]
    return total


def _unmarked(blocks: list[_Block], lines: list[_Line], content: np.ndarray) -> _Block:
    """On a page without marks: the smallest block that holds nearly all chosen text, and the main heading."""
    own: dict[int, int] = {}
    headings: dict[int, int] = {}
    for line, chosen in zip(lines, content, strict=True):
        if chosen:
            own[line.block.number] = own.get(line.block.number, 0) + len(line.text)
        if line.block.tag == "h1" and not line.block.dropped:
            headings[line.block.number] = 1
    text, heads = _sums(blocks, own), _sums(blocks, headings)
    most = (10 * text >= 9 * text[0]) & (heads == heads[0])
    most &= np.array([b.tag in _CONTAINERS for b in blocks])
    return blocks[int(np.flatnonzero(most)[-1])]  # blocks that hold nearly all lie one in the other


def _holds(outer: _Block, block: _Block) -> bool:
    while block.number > outer.number:
        block = block.parent
    return block is outer


def main_text(html: str | None) -> str:
    """The article of one page, its blocks joined by line breaks; empty without one.

    The clustering of lines says where content is. Of marked articles (those in a main part, if it has any) all that
    hold a chosen line are taken, else the main part, else the smallest block with the chosen lines. Inside, blocks
    without a chosen line are left out where their marks are unsure or most of their text is links.
    """
    if not html:
        return ""
    parser = _Lines()
    parser.feed(_MARKED_SECTION.sub(" ", html) if "<![" in html else html)
    parser.close()
    parser.cut()
    lines = [x for x in parser.lines if not x.block.dropped]
    if not lines:
        return ""
    content = content_lines(parser.lines)
    content = content[[not x.block.dropped for x in parser.lines]]
    chosen = [x for x, c in zip(lines, content, strict=True) if c]
    in_main = any(x.block.main >= 0 and x.block.article >= 0 for x in chosen)
    articles = {x.block.article for x in chosen if x.block.main >= 0 or not in_main} - {-1}
    if articles:
        kept = [x for x in lines if x.block.article in articles]
    elif any(x.block.main >= 0 for x in chosen):
        kept = [x for x in lines if x.block.main >= 0]
    elif chosen:
        region = _unmarked(parser.blocks, lines, content)
        kept = [x for x in lines if _holds(region, x.block) and 2 * x.linked <= len(x.text)]  # the rest are menus
    else:
        return ""
    of_unsure = {x.block.unsure for x in chosen}
    lists = _link_lists(parser.blocks, kept, {x.block.number for x in chosen})
    return "\n".join(
        x.text for x in kept if (x.block.unsure < 0 or x.block.unsure in of_unsure) and not lists[x.block.number]
    )


def _link_lists(blocks: list[_Block], lines: list[_Line], chosen: set[int]) -> np.ndarray:
    """Which blocks lie in a list, table or the like whose text is mostly links, with none of the chosen lines."""
    sums = []
    for size in (lambda x: len(x.text), lambda x: x.linked, lambda x: int(x.block.number in chosen)):
        own: dict[int, int] = {}
        for line in lines:
            own[line.block.number] = own.get(line.block.number, 0) + size(line)
        sums.append(_sums(blocks, own))
    text, linked, held = sums
    out = (2 * linked > text) & (held == 0)
    out &= np.array([b.tag in _LISTS for b in blocks])
    for block in blocks[1:]:
        out[block.number] |= out[block.parent.number]
    return out


def extract_main_text(pages: DataFrame, keys: list[str], html: str = "html") -> DataFrame:
    """Main text of every page: the key columns, `text` and `n_chars` (code points).

    One row per input row, repeated rows included; an empty table gives no rows. A null or empty page, or one
    without content, gives the empty text. Other columns are ignored, whatever their names. Pages of any
    length and depth are parsed whole, in memory that grows with their length.
    """
    slots = [f"k{i}" for i in range(len(keys))]
    rows = pages.select(
        *(column(c).alias(s) for c, s in zip(keys, slots, strict=True)), column(html).alias("html")
    )
    schema = rows.drop("html").schema.add("text", "string", False).add("n_chars", "long", False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = [main_text(x) for x in batch.column("html").to_pylist()]
            columns = [batch.column(s) for s in slots]
            counts = pa.array([len(x) for x in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string()), counts], [*slots, "text", "n_chars"])

    return rows.mapInArrow(run, schema).toDF(*keys, "text", "n_chars")
