"""Main text of web pages, by a decision tree over flat text blocks.

A page is read once from front to back and cut into blocks at its block-level tags and at
elements that are marked as something else than text. A block has its words, the share of
them inside links, and the same two figures of the block before and after it; and its part:
in an article or main part (1), on a page that has none (0), beside the article (-0.5), or in
a menu, header, footer, sidebar, form, notice, advert or the readers' comments (-1), by tag,
role or the names of class and id. A decision tree keeps or drops the block. It is grown from
``LABELLED``, a small table of blocks that were labelled by hand.

A mark tells little alone, as names do: of body, article and main no names are asked, a name
such as ``has-sidebar`` or ``no-ads`` says nothing, a name with further words (``related-work``)
says nothing where its mark is a weak one, and an element that holds most of the page's words
and more than two blocks of it, or its first heading or article, is a frame around the page
and no part of it. An article inside a side part is one only if the page has no other.

Scripts, styles and other raw parts and comments are no text. Character references are
decoded, white space inside a block becomes one space, and the kept blocks are joined by
blank lines in page order, all of them whole.

Defined results: a null page is an empty one and has an empty text; unclosed and stray tags,
quotes and comments are allowed and read in one pass, whatever the bytes; a raw element other
than a script or style that is not closed ends at the next block-level tag; null and repeated
ids and urls keep a row each; an empty table gives an empty result; columns other than those
asked for are never read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from spendtide.llm.texts import map_texts

# Blocks labelled by hand: words and link share before, here and after, part, is text.
LABELLED = (
    (0, 0.0, 8, 0.0, 60, 0.0, 1, 1), (12, 0.0, 80, 0.0, 64, 0.0, 1, 1),
    (80, 0.0, 1, 0.0, 70, 0.0, 1, 1), (45, 0.0, 5, 0.0, 0, 0.0, 1, 1),
    (90, 0.1, 120, 0.05, 30, 0.0, 1, 1), (6, 0.0, 30, 0.4, 50, 0.0, 1, 1),
    (1, 0.0, 2, 0.0, 1, 0.0, 1, 1), (50, 0.0, 3, 1.0, 40, 0.0, 1, 1),
    (3, 1.0, 25, 0.0, 5, 1.0, 1, 1), (20, 0.0, 200, 0.0, 9, 0.0, 1, 1),
    (0, 0.0, 4, 0.0, 0, 0.0, 1, 1), (0, 0.0, 1, 0.0, 2, 0.0, 1, 1),
    (0, 0.0, 150, 0.0, 0, 0.0, 1, 1), (1, 1.0, 2, 1.0, 1, 1.0, 1, 1),
    (0, 0.0, 3, 1.0, 0, 0.0, 1, 1), (4, 1.0, 30, 0.9, 3, 1.0, 1, 1),
    (0, 0.0, 1, 1.0, 1, 1.0, -1, 0), (1, 1.0, 1, 1.0, 9, 0.0, -1, 0),
    (1, 1.0, 9, 0.0, 10, 0.0, -1, 0), (4, 0.0, 60, 0.0, 80, 0.0, -1, 0),
    (70, 0.0, 12, 0.0, 0, 0.0, -1, 0), (60, 0.0, 35, 0.0, 40, 0.0, -1, 0),
    (35, 0.0, 40, 0.1, 5, 0.0, -1, 0), (0, 0.0, 6, 0.0, 3, 0.0, -1, 0),
    (9, 0.0, 150, 0.0, 10, 0.2, -1, 0), (5, 1.0, 22, 0.0, 60, 0.0, -1, 0),
    # The same blocks beside an article and on pages without one; all are text inside an
    # article, and none in a side part.
    *((*row, part, text if abs(part) < 1 else int(part == 1)) for *row, text in (
        (0, 0.0, 3, 1.0, 3, 1.0, 0), (3, 1.0, 2, 1.0, 4, 1.0, 0),
        (4, 1.0, 5, 0.8, 50, 0.0, 0), (60, 0.0, 6, 1.0, 5, 1.0, 0),
        (5, 1.0, 4, 0.0, 3, 1.0, 0), (0, 0.0, 2, 0.0, 1, 1.0, 0),
        (3, 1.0, 7, 0.5, 2, 1.0, 0), (30, 0.9, 28, 0.9, 30, 0.9, 0),
        (2, 1.0, 8, 0.0, 0, 0.0, 0), (1, 1.0, 3, 0.0, 0, 0.0, 0),
        (0, 0.0, 7, 0.0, 55, 0.0, 1), (7, 0.0, 55, 0.0, 48, 0.0, 1),
        (55, 0.0, 4, 0.0, 60, 0.0, 1), (48, 0.0, 35, 0.1, 40, 0.0, 1),
        (40, 0.0, 18, 0.0, 3, 1.0, 1), (3, 1.0, 70, 0.0, 50, 0.0, 1),
        (5, 1.0, 90, 0.05, 4, 1.0, 1), (70, 0.0, 11, 0.0, 25, 0.0, 1),
        (25, 0.0, 14, 0.2, 60, 0.0, 1), (4, 1.0, 9, 0.0, 80, 0.0, 1),
        (60, 0.0, 3, 0.0, 45, 0.0, 1), (30, 0.0, 40, 0.3, 30, 0.0, 1),
    ) for part in (-1, -0.5, 0, 1)),
    (0, 0.0, 3, 0.0, 0, 0.0, -0.5, 0), (0, 0.0, 6, 0.0, 2, 0.0, -0.5, 0),
    (2, 0.0, 4, 0.0, 6, 0.0, -0.5, 0), (9, 0.0, 2, 0.0, 0, 0.0, -0.5, 0),
    (0, 0.0, 6, 0.0, 0, 0.0, 0, 1), (0, 0.0, 1, 0.0, 2, 0.0, 0, 1),
    (1, 0.0, 2, 0.0, 2, 0.0, 0, 1), (2, 0.0, 2, 0.0, 0, 0.0, 0, 1),
    (0, 0.0, 1, 0.0, 0, 0.0, 0, 1), (9, 0.0, 3, 0.0, 0, 0.0, 0, 1),
    (6, 0.0, 12, 0.1, 8, 0.0, 0, 1), (0, 0.0, 4, 0.0, 9, 0.0, 0, 1),
)

_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt"
    " fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main"
    " menu nav ol p pre search section summary table tbody tfoot thead title tr ul".split()
)
#: Elements whose end tags close what is open in them.
_PART = frozenset(
    "article aside body center details dialog div dl fieldset figure footer form header main"
    " menu nav ol search section table ul".split()
)
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
#: Elements that are no text; the first ones hold no tags and may be unclosed to the end.
_SCRIPTS = frozenset("script style".split())
_RAW = _SCRIPTS | frozenset(
    "noscript template textarea select title iframe object svg math audio video canvas button"
    " noframes noembed xmp".split()
)
#: What an element's start closes, up to the innermost of the second kind.
_CLOSES = {
    "li": ("li", ("ul", "ol", "menu", "dir")), "dt": ("dt", ("dl",)), "dd": ("dd", ("dl",)),
    "tr": ("tr", ("table",)), "td": ("td", ("table", "tr")), "th": ("th", ("table", "tr")),
}
_AWAY = frozenset("nav footer aside form menu dialog search".split())
_AWAY_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert".split())
_AWAY_WORDS = frozenset(
    "ad ads adv advert adverts advertisement banner breadcrumb breadcrumbs"
    " consent cookie cookies disclaimer footer gdpr login menu modal nav"
    " navbar navigation newsletter notice notification pagination popup promo promoted promotion"
    " recommended related share sharing sidebar signup social sponsor"
    " sponsored subscribe subscription tags toolbar topbar widget widgets".split()
)
#: Words that mark nothing where other words than plain ones stand beside them.
_WEAK_WORDS = frozenset(
    "banner disclaimer login menu notice notification promotion recommended related share"
    " sharing signup social subscription tags".split()
)
_PLAIN_WORDS = frozenset(
    "area articles bar block bottom box button buttons card container content header icons inner"
    " item items left line links list main more news outer panel post posts right row section"
    " site small sticky stories text the title top wrap wrapper".split()
)
_COMMENT_WORDS = frozenset("comment comments discussion disqus replies reply respond".split())
_NOTHING = frozenset("has no not with without is hide hidden show".split())
_NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
_ATTRIBUTE = re.compile(
    r"[\s/]*+(?:(>)|([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>\"'][^\s>]*+))?+)?+)"
)
_WORDS = re.compile(r"[^a-z]+")


@dataclass(frozen=True)
class Block:
    text: str
    words: int
    linked: float
    part: float


@dataclass
class Mark:
    """An element that says what its text is, and what the page has inside it."""

    kind: int
    parent: int
    words: int = 0
    blocks: int = 0
    heads: bool = False


def _named(names: str) -> set[str]:
    """The words of class and id names that mark something."""
    found: set[str] = set()
    for name in names.split():
        words = [w for w in _WORDS.split(name) if w]
        if not words or words[0] in _NOTHING:
            continue
        plain = all(w in _AWAY_WORDS or w in _PLAIN_WORDS for w in words)
        found |= {w for w in words if plain or w not in _WEAK_WORDS}
    return found


def _kind(tag: str, names: str, role: str, within: int) -> int:
    """What an element says about its text: 1 article, -1 something else, -2 the readers'
    comments, 0 nothing. ``within`` is what holds around it."""
    if tag == "body":  # its names and those of articles tell of the page, not of the text
        return 0
    if tag in ("article", "main") and role not in _AWAY_ROLES:
        return 1 if within != -2 else -2  # an article among comments is a comment
    words = _named(names) if names else set()
    if words & _COMMENT_WORDS:
        return -2
    if tag in _AWAY or role in _AWAY_ROLES or words & _AWAY_WORDS:
        return -1
    if role in ("main", "article"):
        return 1 if within != -2 else -2
    if tag == "header" or words & {"header", "masthead"}:
        return 0 if within == 1 else -1
    return 0


class _Next:
    """Where an element's next start or end tag lies; every stretch is searched once."""

    def __init__(self, page: str) -> None:
        self._page, self._found = page, {}

    def __call__(self, name: str, at: int) -> int:
        """The start of the next ``name`` (with its slash) from ``at`` on, or -1."""
        known = self._found.get(name, at - 1)
        if known == -1 or known >= at:
            return known
        place = re.compile(rf"<{name}(?=[\s/>])", re.I).search(self._page, at)
        self._found[name] = place.start() if place else -1
        return self._found[name]


class _Reader:
    """One pass over a page: its blocks, each with the mark it stands in."""

    def __init__(self, page: str) -> None:
        self.page, self.next = page, _Next(page)
        self.found: list[tuple[str, int, float, int]] = []
        self.marks = [Mark(0, -1)]
        # Open elements: tag and the mark in effect inside; where each tag stands.
        self.open: list[tuple[str, int]] = []
        self.places: dict[str, list[int]] = {}
        self.frames: list[int] = []
        self.text: list[tuple[str, bool]] = []
        # The text around marked elements that stand inside a block.
        self.saved: list[tuple[int, list[tuple[str, bool]]]] = []
        self.linked = False
        self.silent = ""

    def mark(self) -> int:
        return self.open[-1][1] if self.open else 0

    def within(self, mark: int) -> int:
        return self.marks[mark].kind

    def flush(self) -> None:
        whole = " ".join(unescape("".join(t for t, _ in self.text)).split())
        if whole:
            count = len(whole.split())
            linked = len(unescape(" ".join(t for t, is_link in self.text if is_link)).split())
            self.found.append((whole, count, min(1.0, linked / count), self.mark()))
        self.text.clear()

    def push(self, tag: str, mark: int) -> None:
        self.places.setdefault(tag, []).append(len(self.open))
        if tag in _PART:
            self.frames.append(len(self.open))
        self.open.append((tag, mark))

    def pop_to(self, place: int) -> None:
        while len(self.open) > place:
            around = self.open[-2][1] if len(self.open) > 1 else 0
            if self.mark() != around or self.open[-1][0] in _BLOCK:
                self.flush()
            tag, _ = self.open.pop()
            self.places[tag].pop()
            if tag in _PART:
                self.frames.pop()
            if self.saved and self.saved[-1][0] == len(self.open):
                self.text = self.saved.pop()[1]

    def last(self, *tags: str) -> int:
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def start(self, tag: str, names: str, role: str) -> None:
        marks = _kind(tag, names, role, self.within(self.mark()))
        inline = tag not in _BLOCK and tag not in ("td", "th")
        if tag in _BLOCK or not inline and (marks or self.places.get(tag)):
            self.flush()
        if tag in _BLOCK:
            self.linked = False
            if (place := self.last("p")) > max(self.last("td", "th"), self.frames[-1] if self.frames else -1):
                self.pop_to(place)  # a paragraph ends where a block begins
        if tag in _CLOSES:
            closed, limits = _CLOSES[tag]
            closed = ("td", "th") if closed in ("td", "th") else ("dt", "dd") if closed in ("dt", "dd") else (closed,)
            if (place := self.last(*closed)) > self.last(*limits):
                self.pop_to(place)
        if tag in ("article", "main", "h1"):
            self.marks[self.mark()].heads = True
        if tag in _VOID:
            return
        mark = self.mark()
        if marks:
            self.marks.append(Mark(marks, mark))
            mark = len(self.marks) - 1
        if marks and inline:
            self.saved.append((len(self.open), self.text))
            self.text = []
        if marks or tag in _PART or tag in ("p", "li", "td", "th", "tr", "dt", "dd") or self.places.get(tag):
            self.push(tag, mark)

    def end(self, tag: str) -> None:
        if tag in _BLOCK:
            self.flush()
            self.linked = False
        place = self.last(tag)
        inline = tag not in _BLOCK and tag not in ("td", "th")
        if place < 0 or (inline and self.frames and self.frames[-1] > place):
            return
        self.pop_to(place)

    def tag(self, at: int) -> int:
        """Read the tag at ``at``; where to go on. The page's rest is lost in a tag that
        does not end."""
        page, ending = self.page, self.page.startswith("/", at + 1)
        name = _NAME.match(page, at + 1 + ending)
        tag = name[0].lower()
        names, role, place, closed = "", "", name.end(), False
        while True:
            part = _ATTRIBUTE.match(page, place)
            if part is None:
                return len(page)
            place, key = part.end(), part[2]
            if part[1]:
                closed = page[place - 2] == "/"
                break
            key = key.lower()
            if key in ("class", "id", "role"):
                value = (part[3] or part[4] or part[5] or "").lower()
                if key == "role":
                    role = value.strip()
                else:
                    names = f"{names} {value}"
        if self.silent and (tag in _BLOCK or (ending and tag == self.silent)):
            self.silent = ""
            if ending and tag not in _BLOCK:
                return place
        if ending:
            if tag == "a":
                self.linked = False
            self.end(tag)
        elif tag in _RAW:
            return self.raw(tag, place, closed)
        elif tag == "a":
            self.linked = True
            if self.kind_of_inline(tag, names, role):
                self.start(tag, names, role)
        else:
            if tag in ("br", "td", "th", "img"):
                self.text.append((" ", self.linked))
            self.start(tag, names, role)
            if closed and self.open and self.open[-1][0] == tag and tag not in _BLOCK:
                self.pop_to(len(self.open) - 1)
        return place

    def kind_of_inline(self, tag: str, names: str, role: str) -> bool:
        return bool(_kind(tag, names, role, self.within(self.mark())) or self.places.get(tag))

    def raw(self, tag: str, place: int, closed: bool) -> int:
        """Pass an element that is no text."""
        if tag == "title":
            self.flush()
        if closed and tag not in _SCRIPTS:
            return place
        end = self.next(f"/{tag}", place)
        if tag in _SCRIPTS:
            return self.after(end)
        again = self.next(tag, place)
        if end >= 0 and not place <= again < end:
            return self.after(end)
        self.silent = self.silent or tag
        return place

    def after(self, end: int) -> int:
        """Behind the end tag at ``end``."""
        stop = self.page.find(">", end) if end >= 0 else -1
        return stop + 1 if stop >= 0 else len(self.page)

    def read(self) -> None:
        page, at = self.page, 0
        while at < len(page):
            begin = page.find("<", at)
            stop = len(page) if begin < 0 else begin
            if stop > at and not self.silent:
                self.text.append((page[at:stop], self.linked))
            if begin < 0:
                break
            follows = page[begin + 1 : begin + 3]
            if follows[:1].isascii() and follows[:1].isalpha() or (
                follows[:1] == "/" and follows[1:].isascii() and follows[1:].isalpha()
            ):
                at = self.tag(begin)
            elif page.startswith("<!--", begin):
                stop = -1 if page.startswith(("<!-->", "<!--->"), begin) else page.find("-->", begin + 4)
                at = self.after(begin) if page.startswith(("<!-->", "<!--->"), begin) else (
                    stop + 3 if stop >= 0 else len(page)
                )
            elif follows[:1] in ("!", "?", "/"):
                at = self.after(begin)
            else:
                if not self.silent and begin + 1 < len(page):
                    self.text.append(("<", self.linked))
                at = begin + 1
        self.pop_to(0)
        self.flush()


#: Share of the page's words from which on a marked element is a frame around the page.
FRAME = 0.5


def blocks(page: str) -> list[Block]:
    """The page's text blocks in order."""
    reader = _Reader(page)
    reader.read()
    marks, total = reader.marks, sum(words for _, words, _, _ in reader.found)
    for _, words, _, mark in reader.found:
        marks[mark].words += words
        marks[mark].blocks += 1
    for mark in reversed(marks[1:]):  # a mark stands behind the one around it
        around = marks[mark.parent]
        around.words, around.blocks = around.words + mark.words, around.blocks + mark.blocks
        around.heads = around.heads or mark.heads or mark.kind == 1
    part = [0.0] * len(marks)
    for k, mark in enumerate(marks[1:], 1):
        around = part[mark.parent]
        frame = mark.words >= FRAME * total and (mark.heads or mark.blocks > 2)
        if mark.kind == -1 and frame:
            part[k] = around
        elif mark.kind == 1:
            part[k] = 2 if around in (-1, 2) else around if around == -2 else 1
        else:
            part[k] = mark.kind
    parts = [part[mark] for _, _, _, mark in reader.found]
    # An article inside a side part is one if the page has no other.
    inner = -1 if 1 in parts else 1
    parts = [inner if p == 2 else max(p, -1) for p in parts]
    beside = -0.5 if 1 in parts else 0
    return [
        Block(text, words, linked, p or beside)
        for (text, words, linked, _), p in zip(reader.found, parts)
    ]


def features(found: list[Block]) -> np.ndarray:
    """One row per block: words and link share before, here and after; part."""
    own = np.array([(b.words, b.linked) for b in found], np.float64).reshape(-1, 2)
    around = np.vstack([np.zeros((1, 2)), own, np.zeros((1, 2))])
    part = np.array([[b.part] for b in found], np.float64).reshape(-1, 1)
    return np.hstack([around[:-2], own, around[2:], part])


@dataclass(frozen=True)
class Node:
    """A leaf (``kept``) or a question: is the feature at most ``limit``?"""

    kept: bool
    feature: int = -1
    limit: float = 0.0
    low: "Node | None" = None
    high: "Node | None" = None


def _impurity(labels: np.ndarray) -> float:
    share = labels.mean() if len(labels) else 0.0
    return len(labels) * share * (1 - share)


def grow(rows: np.ndarray, labels: np.ndarray, depth: int = 8) -> Node:
    """A tree by Gini impurity; questions lie halfway between neighbouring values."""
    leaf = Node(bool(labels.mean() >= 0.5))
    if depth == 0 or labels.min() == labels.max():
        return leaf
    best = None
    for feature in (6, 2, 3, 4, 0, 5, 1):  # of equal questions the plainer one
        values = np.unique(rows[:, feature])
        for limit in (values[1:] + values[:-1]) / 2:
            low = rows[:, feature] <= limit
            left = _impurity(labels[low]) + _impurity(labels[~low])
            if best is None or left < best[0] - 1e-9:
                best = left, feature, float(limit), low
    if best is None or best[0] >= _impurity(labels) - 1e-9:
        return leaf
    _, feature, limit, low = best
    return Node(
        leaf.kept, feature, limit,
        grow(rows[low], labels[low], depth - 1), grow(rows[~low], labels[~low], depth - 1),
    )


def decide(tree: Node, rows: np.ndarray) -> np.ndarray:
    """Which rows the tree keeps."""
    if tree.low is None or tree.high is None:
        return np.full(len(rows), tree.kept)
    low = rows[:, tree.feature] <= tree.limit
    kept = np.zeros(len(rows), bool)
    kept[low], kept[~low] = decide(tree.low, rows[low]), decide(tree.high, rows[~low])
    return kept


@cache
def tree_of(labelled: tuple[tuple[float, ...], ...] = LABELLED) -> Node:
    table = np.array(labelled, np.float64)
    return grow(table[:, :-1], table[:, -1])


def main_texts(pages: list[str], labelled: tuple = LABELLED) -> list[str]:
    """The main text of every page; the tree decides on all pages' blocks at once."""
    found = [blocks(p) for p in pages]
    rows = [features(f) for f in found]
    kept = decide(tree_of(labelled), np.vstack(rows)) if rows else np.empty(0, bool)
    texts, at = [], 0
    for own in found:
        stays = kept[at : at + len(own)]
        texts.append("\n\n".join(b.text for b, k in zip(own, stays) if k))
        at += len(own)
    return texts


def extract(
    pages: DataFrame, html_col: str = "html", keep: dict[str, str] | None = None,
    labelled: tuple = LABELLED,
) -> DataFrame:
    """``keep`` (by default page_id and url), the text and its number of characters."""

    def work(raw: list[bytes]) -> dict[str, pa.Array]:
        texts = main_texts([r.decode("utf-8", "replace") for r in raw], labelled)
        return {
            "text": pa.array(texts, pa.string()),
            "n_chars": pa.array([len(t) for t in texts], pa.int64()),
        }

    keep = {"page_id": "page_id", "url": "url"} if keep is None else keep
    return map_texts(pages, html_col, keep, work, "text string, n_chars long")
