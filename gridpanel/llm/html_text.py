"""Main text of web pages from parser events and text-to-tag ratios.

The page goes once through the standard library's streaming ``html.parser``. Block
tags end a line, so a line is the text of one block, whatever the page's own line
breaks; each line knows how many tags it holds and which region (the innermost
sectioning element) it stands in. On every page the text-to-tag ratio of all lines
(characters per tag), menus and notices included, is smoothed with a Gaussian and cut at
a share of its standard deviation; that decides between the page's regions, and all lines
of a chosen region are kept, short ones too. What the page says of a region comes first:

* never: navigation, page headers, footers, sidebars, notices, adverts, forms and reader
  comments, told by element, ARIA role, or a word of class or id. Within an article or
  main element a class or id must name boilerplate as a whole ("share-buttons", not
  "market-share"). Scripts, styles and the like are no lines at all.
* always: articles and main elements, whatever their ratio.
* by the ratio: parts of an article of which a class or id has a word of boilerplate among
  others; they are content if their smoothed ratio is not far below the article's. On a
  page without an article or main element every region that passes the cut.
* for want of others: articles and main elements that are named like boilerplate
  themselves (class "comment" or "related").

Defined results: null and empty pages give an empty text; unclosed tags end with
their parent block; text outside any tag is a line of the page's body; a repeated
page is a row of its own. Other columns are ignored.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gridpanel.llm.common import byte_slices

#: Element names of HTML by their part on the page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe object svg math canvas audio video map head".split())
BOILERPLATE = frozenset("nav footer aside form button select option textarea input label fieldset dialog menu".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var br wbr img".split())
SECTION = frozenset("body main article section div td blockquote".split())
#: A new paragraph ends an open one, an item an open item, and so on.
ENDED_BY = {"p": frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 "
                           "header hr main nav ol p pre section table ul".split()),
            "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
            "tr": frozenset(["tr", "tbody", "tfoot"]), "td": frozenset("td th tr tbody tfoot".split()),
            "th": frozenset("td th tr tbody tfoot".split()), "option": frozenset(["option", "optgroup"])}
HOLDS = frozenset("ul ol dl table td th div section article main body html blockquote".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog alertdialog menu menubar".split())
WORDS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie "
                  "cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe signup login "
                  "nav navbar navigation menu breadcrumb breadcrumbs sidebar aside widget related recommended footer "
                  "masthead topbar toolbar share sharing social comment comments commentlist respond reply replies "
                  "disqus discussion pagination pager skip toc".split())
LAYOUT = frozenset("has with without no is".split())
#: Elements that are what they are, whatever their class or id.
UNNAMED = frozenset("html body h1 h2 h3 h4 h5 h6".split())
#: What a line may be.
BODY, ARTICLE, SUSPECT, SPARE, NEVER = range(5)
#: Within an article a name holds nothing but words of WORDS and of these; words of FRAME tell nothing.
FRAME = frozenset("area block body box container content inner item items main outer page post section text wrap "
                  "wrapper article".split())
PARTS = FRAME | frozenset("articles bar button buttons count form icon icons label labels link links list notice notices "
                          "posts reader readers site stories thread user users v x js unit slot zone id module teaser card row".split())
#: Words that alone may as well name content: a note, a menu, a section called after its heading (by id).
NOTES = frozenset("alert discussion notice notices".split())
TOPICS = frozenset("advertising banner consent cookie cookies menu navigation promotion reply replies".split())
HEADINGS = TOPICS | frozenset("login newsletter recommended related share sharing signup skip social sponsor sponsored "
                              "subscribe widget".split())
WORD = re.compile(r"[a-z]+")
SPACE = re.compile(r"\s+")


def _whole_name(words: list[str], topics: frozenset) -> bool:
    """Whether a class or id of these words names boilerplate within an article."""
    named = WORDS - NOTES
    if named.isdisjoint(words) or not all(w in named or w in PARTS for w in words):
        return False
    told = set(words) - FRAME
    return len(told) > 1 or told.isdisjoint(topics)


def _words(token: str) -> list[str]:
    """"articleComments" and "article-comments" have the same words."""
    return WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", token).lower())


def _hidden(attrs) -> bool:
    for name, value in attrs:
        value = (value or "").strip().lower()
        if (name == "hidden" or name == "aria-hidden" and value == "true" or name == "role" and value in ROLES
                or name == "style" and re.search(r"display\s*:\s*none", value)):
            return True
    return False


def _told_by_name(tag: str, attrs, inside: bool) -> int:
    """2: a class or id names boilerplate, 1: one holds a word of it among others, 0: none."""
    told = 0
    for name, value in attrs:
        if name not in ("class", "id") or not value or tag in UNNAMED:
            continue
        topics = HEADINGS if name == "id" else TOPICS
        if tag in INLINE:
            topics = topics | {"comment"}   # of a program text
        for token in value.split():
            words = _words(token)
            if tag == "header" and "header" in words and not {"site", "global"}.isdisjoint(words):
                return 2
            # "has-sidebar" tells of a layout around the article
            if not words or words[0] in LAYOUT or WORDS.isdisjoint(words):
                continue
            if not inside or _whole_name(words, topics):
                return 2
            if not (WORDS - NOTES - topics).isdisjoint(words):
                told = 1
    return told


class Lines(HTMLParser):
    """Lines of a page: (text, tags, region, what it may be)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, int]] = []
        self.open: list[tuple[str, bool, int, int]] = []    # name, no text of it counts, region, kind
        self.text: list[str] = []
        self.tags = 0
        self.regions = 0

    def _state(self) -> tuple[bool, int, int]:
        return self.open[-1][1:] if self.open else (False, 0, BODY)

    def end_line(self) -> None:
        text = SPACE.sub(" ", "".join(self.text)).strip()
        if text:
            _, region, kind = self._state()
            self.lines.append((text, self.tags, region, kind))
        self.text.clear()
        self.tags = 0

    def handle_starttag(self, tag, attrs):
        if tag in INLINE:
            self.tags += 1
            if tag == "br":
                self.text.append(" ")
        if tag in VOID:
            if tag not in INLINE:
                self.end_line()
            return
        if tag not in INLINE:
            self.end_line()
            self.tags += 1
            self._close_implied(tag)
        skip, region, kind = self._state()
        if skip or tag in RAW:
            self.open.append((tag, True, region, kind))
            return
        inside = kind in (ARTICLE, SUSPECT, SPARE)
        told = _told_by_name(tag, attrs, inside or tag in ("article", "main"))
        if tag in INLINE:       # only what does not count is kept track of
            if told == 2 or _hidden(attrs) or tag in BOILERPLATE:
                self.open.append((tag, True, region, kind))
            return
        before = kind
        if kind != NEVER:
            if _hidden(attrs) or tag in BOILERPLATE or tag == "header" and not inside:
                kind = NEVER
            elif tag in ("article", "main"):
                kind = SPARE if told == 2 else ARTICLE if kind != SUSPECT else kind
            elif told == 2:
                kind = NEVER
            elif told == 1 and kind == ARTICLE:
                kind = SUSPECT
        if tag in SECTION or kind != before:
            self.regions += 1
            region = self.regions
        self.open.append((tag, False, region, kind))

    def _close_implied(self, tag: str) -> None:
        for i in range(len(self.open) - 1, -1, -1):
            name = self.open[i][0]
            if tag in ENDED_BY.get(name, ()):
                del self.open[i:]
                return
            if name in HOLDS:
                return

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in INLINE:
            self.tags += 1
        else:
            self.end_line()
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                return
            if tag in INLINE and self.open[i][0] not in INLINE:
                return

    def handle_data(self, data):
        if not self._state()[0]:
            self.text.append(data)


def smooth(ratio: np.ndarray, radius: int = 2, sigma: float = 1.0) -> np.ndarray:
    """Gaussian smoothing; at the ends the kernel's part within is used."""
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    if len(ratio) < 2:
        return ratio
    weight = np.convolve(np.ones(len(ratio)), kernel)[radius:radius + len(ratio)]
    return np.convolve(ratio, kernel)[radius:radius + len(ratio)] / weight


def main_lines(lines: list[tuple[str, int, int, int]], share: float = 0.5) -> list[str]:
    """The lines of the regions chosen. A line passes whose ratio, smoothed and by itself
    (else it may owe it to the next region's lines), is at least ``share`` of the ratios'
    standard deviation; a doubtful part of an article must also reach, on the average of its
    characters, that share of the article's own level."""
    if not lines:
        return []
    size = np.array([len(text) for text, *_ in lines], float)
    ratio = size / np.maximum(1, [tags for _, tags, *_ in lines])
    region, kind = (np.array([line[k] for line in lines]) for k in (2, 3))
    level = np.minimum(smooth(ratio), ratio)
    cut = share * ratio.std()
    best = next((k for k in (ARTICLE, SUSPECT, SPARE) if (kind == k).any()), BODY)
    if best == BODY:
        content = set(region[(kind == BODY) & (level >= cut)].tolist())
    else:
        content = set(region[kind == best].tolist())
        own = np.average(level[kind == best], weights=size[kind == best])
        for k in set(region[kind == SUSPECT].tolist()) - content:
            part = region == k
            if np.average(level[part], weights=size[part]) >= max(cut, share * own):
                content.add(k)
    return [line[0] for line in lines if line[2] in content and line[3] != NEVER]


def extract(html: str | None) -> str:
    if not html:
        return ""
    page = Lines()
    page.feed(html)
    page.close()
    page.end_line()
    return "\n".join(main_lines(page.lines))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Rows of (id, url, text, n_chars)."""
    types = {c: pages.schema[c].dataType.simpleString() for c in (id_col, url_col)}

    def task(batches):
        for batch in batches:
            column = batch.column("html")
            for a, b in byte_slices(column, 8 << 20):
                text = [extract(h) for h in column.slice(a, b - a).to_pylist()]
                rows = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("id"), rows.column("url"), pa.array(text, pa.string()),
                     pa.array(map(len, text), pa.int64())], ["id", "url", "text", "n_chars"])

    source = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))
    return (source.mapInArrow(task, f"id {types[id_col]}, url {types[url_col]}, text string, n_chars bigint")
            .withColumnsRenamed({"id": id_col, "url": url_col}))
