"""Main text of a web page by the distribution of text over its lines.

Markup is stripped first: every block element of the page becomes a line, in page order, and parts that by their element or
their class and id names are no content (menus, headers, footers, sidebars, notices, adverts, forms, scripts, comments)
become blank lines, one for all that follow each other. Where the page marks its main part or articles, lines outside of all of them count as blank, too. A line
weighs as many characters as it has outside links, in a marked article as many as it has. The weights are summed over a sliding
window of lines: text surges where a sum reaches ``surge``, and dives where the sums fall to zero; the stretch between a surge
and its dives is a region, from the first line of weight to the last. All regions are the main text, each kept whole; without
any surge the heaviest stretch is.

A name that only mentions a part (``has-sidebar``, ``header-fixed``) says nothing. A named part, or a form, is content all the same
if it holds most of the page's unlinked text and a heading, or nearly all of that text.

An article within the main part, or within an article, belongs to it. Where it lies in a part that is no content by its names,
it counts only if such articles outweigh all other marked lines. A main part without articles is weighed like an article.

Defined results: null and empty pages, and pages without text, give an empty text and 0 characters; html that ends within a
tag, a comment or a script ends there; unclosed elements end with the element around them. Null ids and urls are kept.
Of equally heavy regions the first is kept. Repeated rows give repeated rows. An empty table gives an empty table. Other
columns are ignored.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustlake.llm.frames import byte_texts, in_slices, record

WINDOW = 3
SURGE = 80

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest2>[^>]*)(?:>|\Z)",
    re.DOTALL,
)
_NAMES = re.compile(r"""\b(?:class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.IGNORECASE)

BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section select summary table tbody tfoot thead title tr ul".split()
)
VOID = set("area base basefont br col embed frame hr img input keygen link meta param source track wbr".split())
#: Their contents are no markup.
RAW = set("script style textarea xmp noembed noframes iframe".split())
#: Elements without content of the page.
OUT = set(
    "aside audio button canvas datalist dialog embed footer form frameset head header iframe input label map menu meter nav "
    "noembed noframes noscript object optgroup option progress script search select style svg template textarea title video".split()
)
#: Names in class, id and role that tell the same.
OUT_NAMES = set(
    "ad ads adslot adunit adv advert advertisement advertising adverts adsense alert announcement banner breadcrumb breadcrumbs "
    "captcha complementary consent contentinfo cookie cookies copyright disclaimer footer form gdpr header login masthead menu "
    "modal nav navbar navigation newsletter notice notices notification overlay pager pagination paywall popup promo promoted "
    "promotion search share sharing signup skip social sponsor sponsored subscribe subscription tags teaser toc toolbar topbar "
    "widget widgets".split()
)
#: Names, and elements, around what other people or pages say: an article inside is not the page's.
OTHERS = set(
    "comment comments commentlist discussion disqus feedback recommendations recommended related replies reply respond responses "
    "reviews sidebar sidebars".split()
)
OTHERS_ELEMENTS = {"aside", "footer", "form", "template", "svg"}
#: Names that mean the head of an article inside one, and the head of the page outside.
HEADS = {"header", "masthead"}
#: A name that only says whether, or how, a page shows a part: ``has-sidebar``, ``header-fixed``.
MODIFIED = re.compile(
    r"(?:has|have|with|without|no|not|is|hide|hides|show|shows)[-_].*|.*[-_](?:enabled|disabled|fixed|sticky|ready|collapsed|expanded|visible)",
    re.IGNORECASE,
)
#: Of the page's unlinked text, what a part must hold to be content whatever its name: with a heading or an article in it, or without.
MOST, NEARLY_ALL = 0.5, 0.9
_HEADINGS = {"h1", "article", "main"}
_KEPT = {"html", "body", "main", "article"}
_CLOSED_BY_BLOCK = {"p"}
_SAME_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
                "th": {"td", "th"}, "option": {"option"}}
#: An element that closes implied ones does so no further up than these.
_SCOPES = set("ul ol dl table div section article main body html aside nav footer header form blockquote".split())


#: What a page marks a line as; a doubtful one is in an article within a part that is no content by its names.
UNMARKED, MAIN, ARTICLE, DOUBTFUL = range(4)


class Line(NamedTuple):
    text: str
    weight: int
    mark: int


@dataclass
class _Part:
    """An element that its name or kind takes out of the page, and what it holds."""

    number: int
    index: int
    others: bool
    unlinked: int = 0
    foreign: int = 0  # of that, in parts of others inside
    headed: bool = False

    def takes(self, inner: _Part) -> None:
        self.unlinked += inner.unlinked
        self.foreign += inner.unlinked if inner.others else inner.foreign
        self.headed |= inner.headed


@dataclass
class _Page:
    """Lines under construction, and the elements that are open."""

    content: frozenset[int] = frozenset()  # numbers of elements that are content whatever their names
    lines: list[Line] = field(default_factory=list)
    open: list[tuple[str, int, int]] = field(default_factory=list)  # name, whether its inside is out, mark around it
    places: dict[str, list[int]] = field(default_factory=dict)  # where elements of a name stand in ``open``
    blocks: list[int] = field(default_factory=list)
    scopes: list[int] = field(default_factory=list)
    named: list[_Part] = field(default_factory=list)  # open elements that are out by themselves
    seen: list[_Part] = field(default_factory=list)  # closed ones
    parts: list[str] = field(default_factory=list)
    number: int = 0
    unlinked: int = 0
    foreign: int = 0
    linked: int = 0
    in_link: bool = False
    mark: int = UNMARKED

    @property
    def out(self) -> int:
        return self.open[-1][1] if self.open else 0

    def text(self, piece: str) -> None:
        if not piece:
            return
        if not self.in_link:
            size = len(piece.strip())
            self.unlinked += size
            if self.named:
                self.named[-1].unlinked += size
        if self.out:
            return
        self.parts.append(piece)
        if self.in_link:
            self.linked += len("".join(html.unescape(piece).split()))

    def end_line(self) -> None:
        if self.parts:
            text = " ".join(html.unescape("".join(self.parts)).split())
            if text:
                dense = len(text) - text.count(" ")
                self.lines.append(Line(text, max(0, len(text) if not self.linked else dense - self.linked), self.mark))
        self.parts, self.linked = [], 0

    def blank(self) -> None:
        self.end_line()
        if not self.lines or self.lines[-1].text:
            self.lines.append(Line("", 0, self.mark))

    def push(self, name: str, inside: int) -> None:
        index = len(self.open)
        self.open.append((name, inside, self.mark))
        self.places.setdefault(name, []).append(index)
        if name in BLOCKS:
            self.blocks.append(index)
        if name in _SCOPES:
            self.scopes.append(index)

    def last(self, name: str) -> int:
        """Where the innermost open element of a name stands, -1 if none is open."""
        places = self.places.get(name)
        return places[-1] if places else -1

    def pop(self, index: int) -> None:
        """Close the open elements from ``index`` on."""
        was_out = self.out
        for name, _, mark in reversed(self.open[index:]):
            self.places[name].pop()
            if name in ("article", "main"):
                self.mark = mark
        del self.open[index:]
        for stack in (self.blocks, self.scopes):
            while stack and stack[-1] >= index:
                stack.pop()
        self.leave(index)
        if was_out and not self.out:
            self.blank()

    def leave(self, index: int) -> None:
        while self.named and self.named[-1].index >= index:
            part = self.named.pop()
            self.seen.append(part)
            if self.named:
                self.named[-1].takes(part)
            else:
                self.foreign += part.unlinked if part.others else part.foreign


IN, OUT_OF_PAGE, OUT_FOR_ALL = 0, 1, 2


def _names(rest: str) -> set[str]:
    """The words in class, id and role, both as written together and as capitals divide them."""
    found = set()
    for match in _NAMES.finditer(rest):
        value = match[1] or match[2] or match[3] or ""
        for given in value.split():
            if not MODIFIED.fullmatch(given):
                found.update(re.split(r"[^a-z0-9]+", given.lower()))
                found.update(word.lower() for word in re.findall(r"[A-Z]?[a-z]+", given))
    return found


def _kind(name: str, rest: str, in_article: bool) -> int:
    """Whether an element is part of the page's content; if not, whether an article inside it still may be."""
    words = _names(rest) if rest else set()
    if name in OTHERS_ELEMENTS or words & OTHERS and name not in ("html", "body", "main"):
        return OUT_FOR_ALL
    if name == "article":
        return OUT_FOR_ALL if words & {"ad", "ads", "advert", "advertisement", "sponsored", "promo", "teaser"} else IN
    if name in _KEPT:
        return IN
    if in_article:
        words -= HEADS
        if name == "header":
            return IN
    if name in OUT or words & OUT_NAMES or rest and _HIDDEN.search(rest):
        return OUT_OF_PAGE
    return IN


def _start(page: _Page, name: str, rest: str) -> None:
    if name in BLOCKS:
        page.end_line()
        page.in_link = False
        scope = page.scopes[-1] if page.scopes else -1
        # the outermost implied end within the scope
        first = len(page.open)
        for closed in _SAME_CLOSES.get(name, set()) | _CLOSED_BY_BLOCK:
            places = page.places.get(closed, [])
            inside = bisect_right(places, scope)
            if inside < len(places):
                first = min(first, places[inside])
        if first < len(page.open):
            page.pop(first)
    elif name in ("td", "th", "br"):
        page.text(" ")
    if name == "a":
        page.in_link = True
    if name in VOID:
        return
    page.number += 1
    around = page.out
    own = _kind(name, rest, page.mark > UNMARKED)
    if name in _HEADINGS and page.named:
        page.named[-1].headed = True
    if name in ("article", "main"):
        # a menu or advert around an article was left unclosed before it
        inside = max(own, around if around == OUT_FOR_ALL else IN)
        page.push(name, inside)
        if not inside:
            page.mark = max(page.mark, DOUBTFUL if around else ARTICLE if name == "article" else MAIN)
        return
    if own and (name not in OUT or name == "form"):
        # only a name says so, or a form, which may be around a whole page
        if page.number in page.content:
            own = IN
        else:
            page.named.append(_Part(page.number, len(page.open), bool(_names(rest) & OTHERS)))
    if own and not around:
        page.end_line()
    page.push(name, max(own, around))


def _end(page: _Page, name: str) -> None:
    if name in BLOCKS:
        page.end_line()
    if name in BLOCKS or name == "a":
        page.in_link = False
    index = page.last(name)
    if index >= 0 and (name in BLOCKS or not page.blocks or index > page.blocks[-1]):
        page.pop(index)


def _content_by_weight(page: _Page) -> frozenset[int]:
    """Elements that are out by their names but hold what the page says: most of its unlinked text and its heading, or nearly
    all of its text. What others say (comments) may be long and counts for neither; a part that is theirs by its name must hold
    nearly all of the whole page, with its heading."""
    own = page.unlinked - page.foreign
    found = set()
    for part in page.seen:
        if part.others:
            content = part.headed and part.unlinked > NEARLY_ALL * page.unlinked
        else:
            content = part.unlinked - part.foreign > (MOST if part.headed else NEARLY_ALL) * own
        if content:
            found.add(part.number)
    return frozenset(found)


def lines_of(source: str) -> list[Line]:
    """The page's blocks in order; a part without content is a blank line."""
    page = _read(source)
    content = _content_by_weight(page)
    return _read(source, content).lines if content else page.lines


def _read(source: str, content: frozenset[int] = frozenset()) -> _Page:
    page = _Page(content)
    at = 0
    while True:
        lt = source.find("<", at)
        match = _TAG.match(source, lt) if lt >= 0 else None
        if lt < 0:
            page.text(source[at:])
            break
        if match is None:  # a bare "<" is text
            page.text(source[at : lt + 1])
            at = lt + 1
            continue
        page.text(source[at:lt])
        at = match.end()
        name = (match["name"] or match["name2"] or "").lower()
        if not name:
            continue
        if match["close"] or match["close2"]:
            _end(page, name)
            continue
        rest = match["rest"] if match["name"] else match["rest2"]
        _start(page, name, rest or "")
        if name in RAW and not (rest or "").rstrip().endswith("/"):
            close = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(source, at)
            at = close.end() if close else len(source)
            _end(page, name)
    page.end_line()
    page.leave(0)
    return page


def stretches(weights: list[int], window: int, surge: int) -> list[tuple[bool, int, int, int]]:
    """All stretches between two dives: whether one surges, its weight, first line and end."""
    sums, total = [], sum(weights[: window - 1])
    for i in range(len(weights)):
        total += (weights[i + window - 1] if i + window - 1 < len(weights) else 0) - (weights[i - 1] if i else 0)
        sums.append(total)
    found = []
    start = None
    for i, value in enumerate([*sums, 0]):
        if value and start is None:
            start = i
        elif not value and start is not None:
            inside = [j for j in range(start, i) if weights[j]]
            if inside:
                found.append((max(sums[start:i]) >= surge, sum(weights[start:i]), inside[0], inside[-1] + 1))
            start = None
    return found


def region(weights: list[int], window: int, surge: int) -> tuple[int, int]:
    """First line and end of the heaviest stretch between a surge and its dive; of the heaviest at all if none surges."""
    return max(stretches(weights, window, surge), key=lambda found: found[:2], default=(False, 0, 0, 0))[2:]


def regions(weights: list[int], window: int, surge: int) -> list[tuple[int, int]]:
    """First line and end of every stretch that surges; of the heaviest if none does."""
    return [found[2:] for found in stretches(weights, window, surge) if found[0]] or [region(weights, window, surge)]


def counted_marks(heavy: list[int]) -> set[int]:
    """The marks whose lines count, given the weight of each mark's lines."""
    marks = {MAIN, ARTICLE} if heavy[MAIN] + heavy[ARTICLE] >= heavy[DOUBTFUL] else {MAIN, ARTICLE, DOUBTFUL}
    return marks if any(heavy[mark] for mark in marks) else {UNMARKED, MAIN, ARTICLE, DOUBTFUL}


def extract(source: str, window: int = WINDOW, surge: int = SURGE) -> str:
    """The main text, blocks joined by line breaks."""
    lines = lines_of(source)
    heavy = [0] * 4
    for line in lines:
        heavy[line.mark] += line.weight
    marks = counted_marks(heavy)
    # short blocks and links at an article's ends belong to it
    articles = {mark for mark in marks - {UNMARKED, MAIN} if heavy[mark]}
    whole = set() if UNMARKED in marks else articles or {MAIN}
    weights = [len(line.text) if line.mark in whole else line.weight if line.mark in marks else 0 for line in lines]
    kept = regions(weights, window, surge)
    return "\n".join(line.text for first, end in kept for line in lines[first:end] if line.text and line.mark in marks)


def extract_pages(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """``page_id, url, text, n_chars`` per page."""
    rows = pages.select(
        F.col(id_column).cast("bigint").alias("page_id"),
        F.col(url_column).cast("string").alias("url"),
        F.col(html_column).cast("string").cast("binary").alias("html"),
    )
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            texts = [extract(source.decode("utf-8", "replace")) for source in byte_texts(batch["html"])]
            yield record(schema, batch["page_id"], batch["url"], texts, [len(t) for t in texts])

    return rows.mapInArrow(read, "page_id bigint, url string, text string, n_chars bigint")
