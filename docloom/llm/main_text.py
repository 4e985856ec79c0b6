"""Main text of web pages by the distribution of text over line blocks.

A page's markup is stripped to lines: a line for each block of text, an empty
one where a container begins or ends or something was left out.  The text
lengths of a sliding window of lines, links not counted, rise steeply where the
article begins (a surge point) and fall to nothing where it ends (a dive
point); the text between is kept.  Menus, forms, adverts and the like are
known by element, role, class or id and leave empty lines; where a page names
its article, only that counts.

A null page counts as an empty one and has an empty text; so has a page without
any.  Repeated rows give equal rows, pages of any length are taken whole, and an
empty table gives an empty one.  Only the id, the url and the page are read.
"""

from __future__ import annotations

import html
import itertools
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import small_batches

#: Lines in a window; the text in a window that makes a surge, unless the page has less; a stretch's share of the largest that makes it part of the article.
WINDOW, SURGE, SHARE = 3, 80, 0.2

#: Elements by what they do to the text.
RAW = frozenset("script style textarea title xmp noembed noframes iframe plaintext".split())
LEFT_OUT = frozenset("nav footer aside form button select template svg math canvas object audio video map noscript dialog menu datalist fieldset head".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTAINERS = frozenset("html body main article section div header table thead tbody tfoot ul ol dl center details hgroup search".split())
BLOCKS = CONTAINERS | LEFT_OUT | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd tr td th caption br hr pre blockquote figure figcaption address summary legend option".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
ARTICLE = frozenset("article main".split())
#: The first or last word of a class or id that names something beside the article.
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav navbar navi navigation menu menubar breadcrumb breadcrumbs header "
    "masthead topbar footer sidebar aside widget widgets related recommended recommendations share sharing social newsletter subscribe subscription signup login cookie cookies "
    "consent gdpr notice notices notification popup modal overlay comment comments disqus reply replies respond toolbar pagination pager copyright disclaimer form teaser teasers".split()
)
#: Words that say that what follows isn't this element itself, and of names that say how it is set.
_ABOUT, _STATE = frozenset("has with no without is not".split()), frozenset("open closed enabled disabled on off".split())
#: Elements that end where one of these begins.
CLOSED_BY = {"p": BLOCKS - frozenset(["br"]), "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option"])}

_OPENS = re.compile(r"<(?:(/?)([A-Za-z][^\s/>]*)|!--|!\[CDATA\[|[!?])")
#: To the end of a tag; a sign of comparison in quotes doesn't end it.
_CLOSES = re.compile(r"[^>\"']*+(?:(?:\"[^\"]*+\"|'[^']*+')[^>\"']*+)*+>")
_ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"']+)))?")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


def attributes(text: str) -> dict[str, str]:
    """The first of each of an element's attributes, values decoded."""
    out: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(text):
        out.setdefault(name.lower(), html.unescape(next(filter(None, values), "")))
    return out


def names_other(value: str) -> bool:
    """Whether a class or id names something beside the article, by the first or last word of one of its names."""
    for name in value.split():
        words = [w.lower() for w in _WORD.findall(name)]
        while words and words[-1].isdigit():
            words.pop()
        if not words or words[-1] in _STATE:
            continue
        if words[0] in NAMES or words[-1] in NAMES and not _ABOUT & set(words[:-1]):
            return True
    return False


def tags_of(page: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """(start, end, name, closing, attributes) of each tag; comments and the like have no name, CDATA its text as attributes.

    Each place is looked at a bounded number of times: once a quote is found
    that nothing closes, quotes count no more.
    """
    pos, last, quotes = 0, page.rfind(">"), True
    while (m := _OPENS.search(page, pos)) is not None:
        ends = {"<!--": "-->", "<![CDATA[": "]]>"}.get(m[0])
        if ends:
            at = page.find(ends, m.end())
            inner = page[m.end() : at if at >= 0 else len(page)]
            pos = at + 3 if at >= 0 else len(page)
            yield m.start(), pos, "", False, inner if ends == "]]>" else ""
            continue
        if m.end() > last:
            return
        found = _CLOSES.match(page, m.end()) if quotes else None
        quotes = found is not None
        pos = found.end() if found else page.find(">", m.end()) + 1
        name = (m[2] or "").lower()
        if name in RAW and not m[1] and not page.endswith("/>", 0, pos):
            end = re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I).search(page, pos)
            pos = len(page) if end is None or name == "plaintext" else end.start()
        yield m.start(), pos, name, bool(m[1]), page[m.end() : found.end() - 1] if found else ""


@dataclass
class _Element:
    """An open element: whether it is left out, is the article, or is named as something else, which an article in it refutes."""

    name: str
    left_out: bool
    is_article: bool
    is_doubtful: bool


@dataclass
class Line:
    """A line of a page: its text, the length of it in links, whether it stands in an article, and the doubtful elements around it."""

    text: str = ""
    linked: int = 0
    in_article: bool = False
    doubtful: tuple[int, ...] = ()


@dataclass
class _Lines:
    """The lines of a page in the making."""

    lines: list[Line] = field(default_factory=list)
    parts: list[tuple[str, bool]] = field(default_factory=list)
    vouched: set[int] = field(default_factory=set)

    def text(self, part: str, in_link: bool) -> None:
        self.parts.append((html.unescape(part), in_link))

    def end(self, in_article: bool, doubtful: tuple[int, ...]) -> None:
        """End the line, if it has any text."""
        text = " ".join("".join(p for p, _ in self.parts).split())
        if text:
            linked = sum(len("".join(p.split())) for p, link in self.parts if link)
            self.lines.append(Line(text, linked, in_article, doubtful))
        self.parts.clear()

    def gap(self) -> None:
        self.lines.append(Line())


def lines_of(page: str) -> list[Line]:
    """A page stripped to lines."""
    out, stack, is_open = _Lines(), [], Counter()
    at, doubts = 0, 0
    n_out = n_article = n_link = 0
    doubtful: tuple[int, ...] = ()

    def close() -> None:
        nonlocal n_out, n_article, n_link, doubtful
        e = stack.pop()
        is_open[e.name] -= 1
        n_out, n_article, n_link = n_out - e.left_out, n_article - e.is_article, n_link - (e.name == "a")
        if e.is_doubtful:
            doubtful = doubtful[:-1]

    def begin(name: str, known: dict[str, str]) -> None:
        """Act on the beginning of an element with content."""
        nonlocal n_out, n_article, n_link, doubtful, doubts
        called = known.get("class", ""), known.get("id", "")
        gone = name in LEFT_OUT or known.get("role", "").lower() in ROLES or "hidden" in known or known.get("aria-hidden") == "true"
        gone = (gone or name == "header" and not n_article) and name not in ("html", "body")
        of_article = n_article > 0 and any("header" in map(str.lower, _WORD.findall(c)) for c in called)
        doubt = -1
        if not gone and not n_out and name not in ("html", "body", "main") and not of_article and any(map(names_other, called)):
            doubt, doubts = doubts, doubts + 1
        is_article = name in ARTICLE and doubt < 0 and not n_out
        if is_article:
            out.vouched.update(doubtful)
        if doubt >= 0:
            doubtful = (*doubtful, doubt)
        stack.append(_Element(name, gone, is_article, doubt >= 0))
        is_open[name] += 1
        n_out, n_article, n_link = n_out + gone, n_article + is_article, n_link + (name == "a")

    def leave(name: str) -> None:
        """Act on the end of a block or container."""
        if name in BLOCKS and not n_out:
            out.end(n_article > 0, doubtful)
            if name in CONTAINERS or name in LEFT_OUT:
                out.gap()

    for start, end, name, closing, inner in tags_of(page):
        if not n_out and start > at:
            out.text(page[at:start], n_link > 0)
        at = end
        if not name:
            if inner and not n_out:
                out.text(inner, n_link > 0)
        elif closing:
            if not is_open[name]:
                if name in ("br", "p"):
                    leave(name)
                continue
            while stack[-1].name != name:
                leave(stack[-1].name)
                close()
            leave(name)
            close()
            if not n_out and name in LEFT_OUT:
                out.gap()
        else:
            while stack and name in CLOSED_BY.get(stack[-1].name, ()):
                leave(stack[-1].name)
                close()
            leave(name)
            if name not in VOID and name not in RAW and not (inner.endswith("/") and name == "svg"):
                begin(name, attributes(inner) if inner and not n_out else {})
    if not n_out and at < len(page):
        out.text(page[at:], n_link > 0)
    out.end(n_article > 0, doubtful)
    # what is named as something else is empty, unless an article stands in it
    return [Line() if set(x.doubtful) - out.vouched else x for x in out.lines]


def stretch(weight: list[int], surge: int = SURGE, share: float = SHARE) -> tuple[int, int]:
    """The first line of the article and the one after its last, from the lines' text lengths.

    A surge is the first line from which a window holds enough text, or as much
    as any window of the page; a dive is the line where a window of one line
    less is empty.  Between the first and the last of the stretches that are
    not small beside the largest all is kept.
    """
    n = len(weight)
    sums = [0, *itertools.accumulate(weight)]

    def block(k: int, lines: int) -> int:
        return sums[min(k + lines, n)] - sums[k]

    least = min(surge, max((block(k, WINDOW) for k in range(n)), default=0))
    found: list[tuple[int, int, int]] = []
    k = 0
    while k < n:
        if not weight[k] or block(k, WINDOW) < least:
            k += 1
            continue
        end = next((j for j in range(k, n) if block(j, WINDOW - 1) == 0), n)
        found.append((sums[end] - sums[k], k, end))
        k = end
    large = [f for f in found if f[0] >= share * max(found)[0]]
    return (large[0][1], large[-1][2]) if large else (0, 0)


def main_text(page: str) -> str:
    """The article's blocks in page order, joined by a space."""
    lines = lines_of(page)
    if any(x.in_article for x in lines):  # the page says where: any text there is a surge, and none is small
        lines = [x if x.in_article else Line() for x in lines]
        first, last = stretch([len(x.text) for x in lines], 1, 0.0)
    else:
        weight = [max(len(x.text) - 2 * x.linked, 0) for x in lines]
        first, last = stretch(weight if any(weight) else [len(x.text) for x in lines])
    return " ".join(x.text for x in lines[first:last] if x.text)


def extracted(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    small_batches(df.sparkSession)
    rows = df.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))

    def run(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            texts = [main_text(p or "") for p in batch.column("html").to_pylist()]
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
