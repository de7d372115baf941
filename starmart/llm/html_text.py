"""Main text of web pages by the distribution of line blocks.

Markup is stripped so that every block element becomes a line. A line weighs its text outside links, a heading all of its
text. Weights are summed over sliding windows of lines. Text surges where the windows to its left become empty and dives
where those to its right do. Elements that say they are not main text (menus, forms, comments) are left out with all they hold, and
leave a gap of empty lines where they part the page; an advert or notice between lines of one container does not.

* Where a page marks its article or main content, the surge and the dive are looked for in each marked part: link lists as
  long as a window at its ends fall away, and a part without text outside links (a teaser) goes; every other line is kept.
* Else the stretch with the heaviest window is kept, further ones that come near it, and those in the container of its heaviest line.
* A name that only holds an unwanted word (`ad-hoc`, `with-sidebar`) is a doubt: the element goes if more of its text is
  inside links than outside; else the blocks decide about its lines as about all others.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .staging import carry_modules

#: Lines in a window. A gap of as many empty lines ends the text.
WINDOW = 3
#: A further stretch is kept if its heaviest window reaches this share of the heaviest one.
SHARE = 0.2

# Element names of HTML by role, and words that name what is not main text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
DROPPED = frozenset(
    "aside button canvas dialog footer form head iframe input menu nav noscript object option select svg template textarea".split())
RAW = frozenset("script style title textarea xmp".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
MAIN = frozenset(("article", "main"))
UNWANTED = frozenset(
    "ad ads adbox adslot advert advertisement adverts advertising banner breadcrumb breadcrumbs comment comments commentlist cookie cookies "
    "consent disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices overlay pagination popup promo "
    "promotion related replies respond share sharing sidebar signup skip social sponsor sponsored subscribe teaser toolbar widget".split())
#: Words that say nothing beside an unwanted one: `comment-list` and `site-footer` are as certain as `comments` and `footer`.
NEUTRAL = frozenset(
    "area articles bar block body bottom box button buttons center column container content desktop fixed form group holder icons inline "
    "inner item items label left link links list main mobile module outer page panel placeholder posts right row section site slot stories "
    "thread top unit wrap wrapper".split())
#: Of these the ones that part a page wherever they stand; the others are adverts and notices.
PARTING = frozenset("footer header masthead menu nav".split())
PARTING_NAMES = frozenset(
    "breadcrumb breadcrumbs comment comments commentlist disqus footer header masthead menu nav navbar navigation pagination replies respond "
    "sidebar toolbar".split())
#: Elements whose lines belong together.
CONTAINERS = frozenset("blockquote center div section td th".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
UNWANTED_ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
PARTING_ROLES = frozenset("contentinfo menu menubar navigation toolbar".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*+>|<\?[^>]*+>"
    r"|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>"
    r"|<(/?)([A-Za-z][^\s/>]*+)([^>]*+)\Z", re.S)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_WORD = re.compile(r"[A-Za-z]{2,}")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

WANTED, DOUBTFUL, NOTICE, PART = range(4)


def _named(token: str) -> int:
    """What one class or id says: an unwanted word alone or beside neutral ones is certain, beside others a doubt."""
    words = [token.lower()]
    if words[0] not in UNWANTED:
        words = [w.lower() for w in _WORD.findall(_CAMEL.sub(" ", token))]
    said = UNWANTED.intersection(words)
    if not said:
        return WANTED
    if not all(w in UNWANTED or w in NEUTRAL for w in words):
        return DOUBTFUL
    return NOTICE if PARTING_NAMES.isdisjoint(said) else PART


def _judge(name: str, attributes: str, in_main: bool) -> int:
    """What an element's name and attributes say of its content."""
    if name == "header" or name in DROPPED:
        return WANTED if name == "header" and in_main else PART if name in PARTING else NOTICE
    if name in ("body", "html", "main") or not attributes:
        return WANTED
    found, tokens = WANTED, []
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key == "role" and value.lower() in UNWANTED_ROLES:
            found = max(found, PART if value.lower() in PARTING_ROLES else NOTICE)
        elif key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            found = max(found, NOTICE)
        elif key in ("class", "id"):
            tokens += value.lower().split()
            for token in value.split():
                said = _named(token)
                if in_main and said == PART and token.lower() == "header":
                    said = DOUBTFUL  # an article's own header
                found = max(found, said)
    if name == "article" and found > DOUBTFUL and "comment" not in tokens and any(_named(t) == WANTED for t in tokens):
        return DOUBTFUL  # an article with a label
    return found


class Tags:
    """The tags of a page in order, with the place where each element ends."""

    def __init__(self, page: str):
        self.page = page
        self._sums: list[tuple[int, int]] = []  # code points outside and inside links before each tag
        #: (start, end, closing, name, attributes)
        self.tags: list[tuple[int, int, bool, str, str]] = []
        #: the tag that ends an element: its closing tag, or the next block's for a paragraph or list item left open
        self.end: list[int] = []
        #: names of elements of which one was never closed
        self.unclosed: set[str] = set()
        at = 0
        while match := _TOKEN.search(page, at):
            at = match.end()
            slash, name, attributes = next(((match[i - 1], match[i], match[i + 1]) for i in (2, 5, 8) if match[i]), ("", "", ""))
            name = name.lower()
            if name in RAW and not slash:  # what it holds is no markup
                end = re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*+>?", re.I).search(page, at)
                at, name = end.end() if end else len(page), ""
            self.tags.append((match.start(), at, bool(slash), name, attributes))
        self._pair()

    def _pair(self) -> None:
        self.end = [-1] * len(self.tags)
        waiting: dict[str, list[int]] = {}
        paragraph = -1  # the open one
        items: list[int] = []  # open lists and list items
        for i, (_, _, closing, name, _) in enumerate(self.tags):
            if not name or name in VOID:
                continue
            if name in BLOCKS and paragraph >= 0:
                self.end[paragraph] = i
                paragraph = -1
            if name in ("li", "ul", "ol"):
                if closing:
                    while items and (name != "li" or self.tags[items[-1]][3] == "li"):
                        last = items.pop()
                        self.end[last] = i
                        if self.tags[last][3] == name:
                            break
                else:
                    if name == "li" and items and self.tags[items[-1]][3] == "li":
                        self.end[items.pop()] = i
                    items.append(i)
            elif name == "p":
                paragraph = -1 if closing else i
            elif not closing:
                waiting.setdefault(name, []).append(i)
            elif waiting.get(name):
                self.end[waiting[name].pop()] = i
        self.unclosed = {name for name, left in waiting.items() if left}

    def after(self, i: int) -> tuple[int, int]:
        """Where the page goes on behind the element that tag `i` opens: the next tag, and the place of the text before it.

        An element that was never closed ends before the next article or main content, or with the page. Which of several
        elements of one name was not closed cannot be told, so this holds for all of that name; an article inside any other
        element is part of it.
        """
        name, end = self.tags[i][3], self.end[i]
        if end < 0 or name in self.unclosed:
            for j in range(i + 1, len(self.tags) if end < 0 else end):
                if self.tags[j][3] in MAIN and not self.tags[j][2]:
                    return j, self.tags[j][0]
        if end < 0:
            return len(self.tags), len(self.page)
        own = self.tags[end][2] and self.tags[end][3] == name
        return (end + 1, self.tags[end][1]) if own else (end, self.tags[end][0])

    def lists_links(self, i: int) -> bool:
        """Whether the element that tag `i` opens has no more text outside links than inside, and is not half of the page."""
        if not self._sums:
            free = linked = links = 0
            for j, (_, at, closing, name, _) in enumerate(self.tags):
                if name == "a":
                    links = not closing
                self._sums.append((free, linked))
                text = len(self.page[at: self.tags[j + 1][0] if j + 1 < len(self.tags) else len(self.page)].strip())
                free, linked = (free, linked + text) if links else (free + text, linked)
            self._sums.append((free, linked))
        if self.end[i] < 0:
            return False
        free, linked = (y - x for x, y in zip(self._sums[i], self._sums[self.end[i]], strict=True))
        return linked >= free and 2 * free < self._sums[-1][0]


class Lines:
    """The lines of a page, with weights, containers, and whether they lie in an article or main element."""

    def __init__(self, page: str):
        self.texts: list[str] = []
        self.weights: list[int] = []
        self.main: list[bool] = []
        self.within: list[int] = []
        self.outer: list[int] = [0]  # the container around each container; 0 is the page
        self._parts: list[str] = []
        self._free = 0  # code points outside links
        self._in_main = self._links = self._heading = 0
        self._open: list[tuple[str, int]] = [("", 0)]  # containers, with numbers
        self._opened = dict.fromkeys(CONTAINERS, 0)
        self._last, self._notice = 0, False  # the last line's container, and whether a notice came after it
        self._read(page)
        self._line()

    def _add(self, text: str, weight: int, main: bool) -> None:
        self.texts.append(text)
        self.weights.append(weight)
        self.main.append(main)
        self.within.append(self._open[-1][1])

    def _line(self) -> None:
        text = " ".join("".join(self._parts).split())
        if text:
            within = self._open[-1][1]
            if self._notice and within != self._last:
                self._space()
            self._last, self._notice = within, False
            self._add(text, self._free, self._in_main > 0)
        self._parts, self._free = [], 0

    def _gap(self) -> None:
        self._line()
        self._space()

    def _space(self) -> None:
        for _ in range(WINDOW):
            self._add("", 0, False)

    def _text(self, raw: str) -> None:
        text = html.unescape(raw) if "&" in raw else raw
        self._parts.append(text)
        if self._heading or not self._links:
            self._free += len(text.strip())

    def _read(self, page: str) -> None:
        found = Tags(page)
        tags, i, at = found.tags, 0, 0
        while i < len(tags):
            start, end, closing, name, attributes = tags[i]
            if start > at:
                self._text(page[at:start])
            at, i = end, i + 1
            if not name:
                continue
            if not closing and name not in VOID and (name in DROPPED or name == "header" or attributes):
                said = _judge(name, attributes, self._in_main > 0)
                if said > DOUBTFUL or said == DOUBTFUL and found.lists_links(i - 1):
                    if said == PART and not self._in_main:
                        self._gap()
                    else:
                        self._line()
                        self._notice = not self._in_main
                    i, at = found.after(i - 1)
                    continue
            if name in HEADINGS:
                self._heading = 0 if closing else 1
            if name == "br" or name == "wbr":
                self._parts.append(" " if name == "br" else "")
            elif name in MAIN:
                self._gap()
                self._in_main = max(0, self._in_main + (-1 if closing else 1))
            elif name == "a":
                self._links = 0 if closing else 1
            elif name in BLOCKS:
                self._line()
                if name in CONTAINERS and not closing:
                    self._open.append((name, len(self.outer)))
                    self.outer.append(self._open[-2][1])
                    self._opened[name] += 1
                elif name in CONTAINERS and self._opened[name]:
                    last = ""
                    while last != name:
                        last = self._open.pop()[0]
                        self._opened[last] -= 1
        self._text(page[at:])

    def inside(self, line: int, container: int) -> bool:
        """Whether a line stands in a container, at any depth."""
        at = self.within[line]
        while at > container:  # an outer container has a smaller number
            at = self.outer[at]
        return at == container


def _stretches(weights: list[int]) -> list[tuple[int, int, int]]:
    """(first heavy line, last heavy line, heaviest window) between each surge, where a window first has weight after an
    empty one, and the dive into the next empty window."""
    n, sums = len(weights), [0]
    for w in weights:
        sums.append(sums[-1] + w)
    out: list[tuple[int, int, int]] = []
    first = last = -1
    peak = 0
    for k, w in enumerate(weights):
        if not w:
            continue
        if last >= 0 and k - last > WINDOW:  # a window between them is empty
            out.append((first, last, peak))
            first, peak = k, 0
        first, last = (k if first < 0 else first), k
        peak = max(peak, *(sums[min(n, i + WINDOW)] - sums[i] for i in range(max(0, k - WINDOW + 1), k + 1)))
    return out + [(first, last, peak)] if last >= 0 else out


def _marked(lines: Lines) -> list[int]:
    """The wanted lines of the marked content: of each part all but the link lists, a window or longer, at its ends."""
    kept: list[int] = []
    n, low = len(lines.texts), 0
    while low < n:
        if not lines.main[low]:
            low += 1
            continue
        high = low
        while high < n and lines.main[high]:
            high += 1
        stretches = _stretches(lines.weights[low:high])
        if stretches:
            first, last = low + stretches[0][0], low + stretches[-1][1]
            kept += range(low if first - low < WINDOW else first, high if high - 1 - last < WINDOW else last + 1)
        low = high
    return kept or [k for k in range(n) if lines.main[k]]


def _unmarked(lines: Lines) -> list[int]:
    """The lines of the heaviest stretch, of those that come near it and of those in the container of its heaviest line."""
    weights = lines.weights
    stretches = _stretches(weights)
    if not stretches:
        return []
    first, last, peak = max(stretches, key=lambda s: s[2])
    home = lines.within[max(range(first, last + 1), key=weights.__getitem__)]
    kept: list[int] = []
    for low, high, heaviest in stretches:
        if heaviest >= SHARE * peak or home and any(weights[k] and lines.inside(k, home) for k in range(low, high + 1)):
            kept += range(low, high + 1)
    return kept


def main_text(page: str | None) -> str:
    """The main text of a page, one block to a line; empty for NULL, an empty page and one without text."""
    if not page:
        return ""
    lines = Lines(page)
    # the page may say where its article is
    marked = any(m and t for m, t in zip(lines.main, lines.texts, strict=True))
    return "\n".join(lines.texts[k] for k in (_marked(lines) if marked else _unmarked(lines)) if lines.texts[k])


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row, in one pass without a shuffle; other columns are left out."""
    carry_modules(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py()) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return pages.selectExpr("cast(page_id as long) page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
