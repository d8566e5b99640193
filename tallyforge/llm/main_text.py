"""HTML extraction: text-to-tag ratio per line, smoothed, clustered, grown to the content region.

The events of the standard-library parser are cut into lines, one per block element.  A line's ratio
is its characters over the tags met in it.  The ratios are smoothed by a Gaussian over neighbouring
lines and split in two clusters by a threshold; the lines of the upper cluster say where the content
lies.  The deepest element that holds ``REGION_SHARE`` of their text is the core of the region; it grows to
every element around it that adds ``GROWN_SHARE`` of that text or more, so parts that stand side by side
stay together.  An <article>, or else a <main>, that holds the core's share goes before others.  The
text is every line of the region that is not page furniture (menus, headers, footers, sidebars, notices,
adverts, forms, scripts, styles, reader comments), short lines included.
A class or id that has a word for furniture makes an element furniture, unless it says that there is none
or in what state it is (``no-sidebar``, ``comments-open``), and unless the element holds most of the content.

A page is parsed once.  Elements are numbered as they open and know their parents, so masses are added up
from the last element to the first, and neither depth nor unclosed elements cost more than their number.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import need, schema

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
UNREAD = set("script style noscript template title svg canvas iframe object select button textarea".split())
FURNITURE = UNREAD | set("head nav header footer aside form menu dialog fieldset".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol p pre section summary "
    "table tbody td tfoot th thead tr ul".split()
)
FURNITURE_ROLES = set("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
FURNITURE_WORDS = set(
    "ad ads adbox advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar "
    "menu nav navbar navigation header footer masthead breadcrumb breadcrumbs comment comments notice notices "
    "cookie cookies consent gdpr popup modal overlay newsletter subscribe signup login share sharing social "
    "related widget toolbar pagination pager disqus reply replies respond alert alerts".split()
)
#: Words that say of furniture that it is not here, or how it is: the name of what is around it.
STATES = set("no not has have with without open opened closed on off enabled disabled hide show".split())
#: Parts of an article whose header is its title.
TITLED = set("entry article post content story".split())
INLINE = set("p b i em strong span a".split())
CLOSED_BY_ITSELF = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr",), "th": ("tr",)}
WORD = re.compile(r"[a-z]+")
#: Width of the smoothing in lines, and the share of the content text that a region must hold.
SIGMA, REGION_SHARE = 1.0, 0.7
#: What an element around the core must add to take part.
GROWN_SHARE = 0.1


def _names_furniture(token: str) -> bool:
    """Whether a whole class or id says furniture; ``no-sidebar``, ``comments-open``, ``entry-header`` do not."""
    words = set(WORD.findall(token))
    said = words & FURNITURE_WORDS
    if not words.isdisjoint(TITLED):
        said -= {"header"}
    return bool(said) and words.isdisjoint(STATES)


class _Page(HTMLParser):
    """Cuts a page into lines: pieces of text with their elements, tags, and the element around."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[list[tuple[str, int]], int, int]] = []
        # Of every element by number; the first is the page itself.
        self.kinds, self.parents, self.depths = [""], [-1], [0]
        self.hard, self.named = [False], [False]  # furniture for what it is, or only by its name
        self._open: list[int] = [0]
        self._places: dict[str, list[int]] = {}  # where elements of each tag are among the open ones
        self._tags_of = [""]
        self._pieces: list[tuple[str, int]] = []
        self._tags = 0
        self.feed(html)
        self.close()
        self.flush()

    def _is_furniture(self, tag: str, attrs) -> bool:
        if tag in FURNITURE:
            return True
        for name, value in attrs:
            if name == "hidden" or name == "aria-hidden" and value == "true":
                return True
            if not value:
                continue
            if name == "role" and value.strip().lower() in FURNITURE_ROLES:
                return True
            if name == "style" and re.search(r"display\s*:\s*none", value, re.IGNORECASE):
                return True
        return False

    def _is_named_furniture(self, tag: str, attrs) -> bool:
        return tag not in ("html", "body") and any(
            name in ("class", "id") and value and any(map(_names_furniture, value.lower().split())) for name, value in attrs
        )

    def flush(self) -> None:
        if self._pieces:
            self.lines.append((self._pieces, self._tags, self._open[-1]))
        self._pieces, self._tags = [], 0

    def _close(self, tag: str, within: tuple[str, ...] = ()) -> None:
        """Close the innermost open element of this name and all inside it, if there is one."""
        places = self._places.get(tag)
        if not places or any(self._places.get(w) and self._places[w][-1] > places[-1] for w in within):
            return
        at = places[-1]
        for element in self._open[at:]:
            self._places[self._tags_of[element]].pop()
        del self._open[at:]

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self.flush()
            self._close("p")
            if tag == "body":
                self._close("head")
            if tag in CLOSED_BY_ITSELF:
                self._close(tag, CLOSED_BY_ITSELF[tag])
        self._tags += 1
        if tag in VOID:
            if tag == "br":
                self._pieces.append((" ", self._open[-1]))
            return
        around, element = self._open[-1], len(self.kinds)
        self.kinds.append("main" if dict(attrs).get("role") == "main" else tag)
        self._tags_of.append(tag)
        self.parents.append(around)
        self.depths.append(self.depths[around] + 1)
        hard = self._is_furniture(tag, attrs)
        self.hard.append(hard)
        self.named.append(not hard and self._is_named_furniture(tag, attrs))
        self._places.setdefault(tag, []).append(len(self._open))
        self._open.append(element)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self.flush()
        self._tags += 1
        self._close(tag)

    def handle_data(self, data):
        self._pieces.append((data, self._open[-1]))

    def furniture(self, spared: frozenset[int] | None) -> list[bool]:
        """Whether each element is furniture or in it; names count but for those spared, None for all."""
        out = []
        for element, parent in enumerate(self.parents):
            named = spared is not None and self.named[element] and element not in spared
            out.append(self.hard[element] or named or parent >= 0 and out[parent])
        return out

    def read(self, furniture: list[bool]) -> list[tuple[str, int, int]]:
        """(text, tags, element) of the lines that are no furniture and hold text.

        Furniture inside a block of content, such as a script in a paragraph, leaves no text.
        """
        lines = []
        for pieces, tags, element in self.lines:
            kept = (t for t, e in pieces if not furniture[e] or self._tags_of[e] in BLOCKS)
            if text := " ".join("".join(kept).split()):
                lines.append((text, 0 if furniture[element] else max(1, tags), element))
        return lines

    def summed(self, values: list[tuple[int, int]]) -> list[int]:
        """What the lines in each element have together, from (element, value) of lines."""
        out = [0] * len(self.parents)
        for element, value in values:
            out[element] += value
        for element in range(len(out) - 1, 0, -1):
            out[self.parents[element]] += out[element]
        return out


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """The ratios under a Gaussian kernel, with the ends mirrored by renormalising."""
    radius = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(ratios)), kernel)[radius : radius + len(ratios)]
    return np.convolve(ratios, kernel)[radius : radius + len(ratios)] / weight


def threshold(values: np.ndarray) -> float:
    """Midpoint of two means of the values, from their extremes until it rests."""
    low, high = float(values.min()), float(values.max())
    middle = (low + high) / 2
    for _ in range(32):
        upper, lower = values[values >= middle], values[values < middle]
        if not len(lower):
            break
        moved = (float(upper.mean()) + float(lower.mean())) / 2
        if moved == middle:
            break
        middle = moved
    return middle


def _content_lines(lines) -> list[bool]:
    """Whether each line is of the upper cluster of smoothed ratios; lines of furniture, without tags, are not."""
    ratios = np.array([len(text) / tags if tags else 0.0 for text, tags, _ in lines])
    smooth = smoothed(ratios)
    return [bool(above and tags) for above, (_, tags, _) in zip(smooth >= threshold(smooth), lines)]


def _spared(page: _Page, lines) -> frozenset[int]:
    """Elements named like furniture that are the page's content all the same.

    Such an element holds more than half of the content text, in several lines, or all text of the page.
    """
    content = _content_lines(lines) if lines else []
    mass = page.summed([(e, len(t) * c) for (t, _, e), c in zip(lines, content)])
    count = page.summed([(e, int(c)) for (_, _, e), c in zip(lines, content)])
    every = page.summed([(e, 1) for _, tags, e in lines if tags])
    named = (e for e, is_named in enumerate(page.named) if is_named)
    return frozenset(e for e in named if every[0] and (every[e] == every[0] or 2 * mass[e] > mass[0] and count[e] > 1))


def main_text(html: str) -> str:
    """The main text of one page, blocks joined by a line feed; empty if there is none."""
    page = _Page(html)
    furniture = page.furniture(None)
    lines = page.read(furniture)
    if any(page.named):
        furniture = page.furniture(_spared(page, lines))
        lines = page.read(furniture)
    if not any(tags for _, tags, _ in lines):
        return ""
    mass = page.summed([(e, len(t) * c) for (t, _, e), c in zip(lines, _content_lines(lines))])
    total, region = mass[0], 0
    if total:
        holding = [
            e for e in range(1, len(mass)) if mass[e] >= REGION_SHARE * total and page.kinds[e] not in INLINE and not furniture[e]
        ]
        region = around = max(holding, key=lambda e: (page.depths[e], -e), default=0)
        while around:
            inner, around = around, page.parents[around]
            if mass[around] - mass[inner] >= GROWN_SHARE * total:
                region = around
        # A named element takes in the short lines around the core.
        named = [e for e in holding if page.kinds[e] in ("article", "main")]
        region = max(named, key=lambda e: (page.kinds[e] == "article", page.depths[e], -e), default=region)
    inside = [False] * len(mass)
    for element, parent in enumerate(page.parents):
        inside[element] = element == region or parent >= 0 and inside[parent]
    return "\n".join(text for text, tags, element in lines if tags and inside[element])


def extract_main_text(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """One row per page: its key, url, text and number of code points.

    A null or empty page, or one without content, has an empty text.  Broken markup is read as far
    as it goes.  Repeated rows each get a row, an empty table gives none, other columns are not
    looked at.  A page is worked on whole, in one task; nothing is shuffled.
    """
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}

    def extract(batches):
        for batch in batches:
            texts = []
            for html in batch.column(2):
                page = html.as_py()
                texts.append(main_text(page) if page else "")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=[key, "url", "text"]
            )

    read = need(pages, key, "url", "html").mapInArrow(
        extract, schema(f"`{key}` {kinds[key]}, url string, text string")
    )
    return read.withColumn("n_chars", F.length("text").cast("long"))
