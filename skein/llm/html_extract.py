"""Main text of web pages by a minimum cut.

A page is read into blocks: the text between block-level tags, with character references decoded
in each text and white space collapsed. A classifier gives each block bounded log-odds of
being content, from its own text (length, end of sentence, share of links, heading) and from what the elements
around it are called: their tags, and the words of their class, id and role, of which some say much
and some little. Positive log-odds are its capacity from the source, negative ones to the sink.

Elements are nodes too. One that is meant to hold the article (``article``, ``main``, a class like content) has a
capacity from the source of its own and an edge of little capacity to each block in it; blocks under one parent
meet in a node; neighbours in page order have an edge, whatever they look like. The cut of least
cost labels all blocks at once: a short line between paragraphs of an article is kept though its text says nothing,
a long advert isn't, and a class that says little is overruled by what is around it.

Scripts, styles, templates, comments and the head have no text and never become blocks.
Everything of a page is computed in the worker that reads it: no shuffle.

Defined results: null and empty html give an empty text; a page without markup is one block;
unclosed elements end with their parents; unclosed tags are text; a null url or id is carried; repeated rows each get
a row; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.common import table

_NAME = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9:-]*)")
#: The rest of a tag without angle brackets in its quotes, as almost all are; it doesn't look beyond the next bracket.
_PLAIN = re.compile(r"[^<>\"']*(?:(?:\"[^\"<>]*\"|'[^'<>]*')[^<>\"']*)*>")
_STOP = re.compile(r"[>\"']")
_RAW = {tag: re.compile(rf"(?i)</{tag}\s*>") for tag in ("script", "style", "textarea", "title", "iframe", "noscript")}
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPACE = re.compile(r"\s+")
#: Elements whose content is no text of the page.
SILENT = frozenset("script style noscript template head title svg math iframe object canvas audio video select option datalist textarea".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul br".split()
)
#: An opening tag ends these open elements (up to the nearest of the second set).
_CLOSES = {"li": ({"li", "p"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd", "p"}, {"dl"}), "dd": ({"dt", "dd", "p"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
_KINDS = list({(frozenset(ends), frozenset(stops)) for ends, stops in _CLOSES.values()})
_MARKED = frozenset().union(*(ends | stops for ends, stops in _KINDS))
#: For an opening tag, which of these it ends.
CLOSES = {tag: _KINDS.index((frozenset(ends), frozenset(stops))) for tag, (ends, stops) in _CLOSES.items()}
_P_ENDS = BLOCKS - {"br", "body", "html", "button"}
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
#: Words of a class or id that say much against its text, or little; and words for what holds the article.
AWAY = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar footer masthead banner ad ads advert adverts advertisement advertising adsbygoogle sponsor sponsored promo promotion"
    " cookie cookies consent gdpr notice popup modal overlay subscribe subscription newsletter signup login share sharing social related recommended recommendations widget toolbar pagination pager"
    " comment comments commentlist disqus replies respond copyright outbrain taboola".split()
)
DOUBT = frozenset("header side search form alert tags legal disclaimer discussion reviews hidden print reply more".split())
HERE = frozenset("article content main post entry story body articlebody prose hentry".split())
MUCH, LITTLE = 6.0, 2.0
_HIDING = re.compile(r"(?i)display\s*:\s*none|visibility\s*:\s*hidden")
_ROLES_AWAY = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
TAGS_AWAY = frozenset("nav header footer aside form button dialog menu fieldset label search".split())
TAGS_HERE = frozenset("article main".split())


class Tags:
    """The tags of a page, asked for in order. What ends where is found out once for the whole page, so a page costs its length, whatever is left open in it.

    A tag ends at the first ``>`` outside quotes. One whose quote isn't closed, or that has no end, is text; an unclosed comment goes to the end.
    """

    __slots__ = ("page", "stops", "ends", "at", "last")

    def __init__(self, page: str) -> None:
        self.page, self.at, self.last, self.stops = page, 0, page.rfind(">"), None

    def look_ahead(self) -> None:
        """Finds all stops, and where a tag ends that meets one."""
        page = self.page
        self.stops = [m.start() for m in _STOP.finditer(page)]
        # Outside quotes: there, or where it ends after the quote that opens there.
        self.ends = [-1] * (len(self.stops) + 1)
        closes = {'"': len(self.stops), "'": len(self.stops)}
        for k in reversed(range(len(self.stops))):
            c = page[self.stops[k]]
            if c == ">":
                self.ends[k] = self.stops[k]
            else:
                self.ends[k] = self.ends[min(closes[c] + 1, len(self.stops))]
                closes[c] = k

    def end_of(self, at: int) -> int:
        """Where the tag ends whose name ends here, -1 if nowhere. Asked for ascending places."""
        if m := _PLAIN.match(self.page, at):
            return m.end() - 1
        if self.stops is None:
            self.look_ahead()
        while self.at < len(self.stops) and self.stops[self.at] < at:
            self.at += 1
        return self.ends[self.at]

    def next(self, at: int) -> tuple[int, int, str, str | None, str] | None:
        """(begin, end, slash, name, attributes) of the next tag; a comment or declaration has no name."""
        page = self.page
        while (begin := page.find("<", at)) >= 0:
            if page.startswith("<!--", begin):
                close = page.find("-->", begin + 4)
                return begin, close + 3 if close >= 0 else len(page), "", None, ""
            if (m := _NAME.match(page, begin)) and (end := self.end_of(m.end())) >= 0:
                return begin, end + 1, m[1], m[2], page[m.end() : end]
            if page[begin + 1 : begin + 2] in ("!", "?", "/") and begin + 2 <= self.last:
                return begin, page.find(">", begin + 2) + 1, "", None, ""
            at = begin + 1
        return None


class Block:
    __slots__ = ("text", "words", "linked", "parent", "away", "scope", "heading")

    def __init__(self, text: str, linked: int, element: Element) -> None:
        self.text, self.linked, self.parent = text, linked, element
        self.words = text.count(" ") + 1
        self.away, self.scope, self.heading = element.away, element.scope, element.heading


def said_by(names: str) -> tuple[float, bool]:
    """What a class or id says: how much against its text, and whether it names what holds the article."""
    against, here = 0.0, False
    for name in names.split():
        words = {w.lower() for w in _WORD.findall(name)}
        if words & AWAY:
            against = MUCH
        elif words & DOUBT:
            against = max(against, LITTLE)
        elif words & HERE:
            here = True
    # One of several names that is just "post" or the like: the others tell what else there is about it.
    if against and any(name.lower() in HERE for name in names.split()):
        return LITTLE, here
    return against, here and not against


class Element:
    """away: log-odds against the texts in it. scope: the nearest element that is meant to hold the article, and how much that counts."""

    __slots__ = ("tag", "parent", "away", "scope", "strength", "heading", "silent", "link", "block", "ended", "inline")

    def __init__(self, tag: str, parent: Element | None, attributes: str) -> None:
        self.tag, self.parent, self.strength = tag, parent, 0.0
        # The nearest block, itself included; how many elements of each inline tag are open in a block; what each kind of opening tag ends.
        self.block = self if tag in BLOCKS or not parent else parent.block
        self.inline: dict[str, int] | None = {} if self.block is self else None
        if not parent:
            self.ended = (None,) * len(_KINDS)
        elif tag in _MARKED:
            self.ended = tuple(None if tag in stops else e or (self if tag in ends else None) for (ends, stops), e in zip(_KINDS, parent.ended))
        else:
            self.ended = parent.ended
        up = parent
        self.away, self.scope, self.heading, self.silent, self.link = (up.away, up.scope, up.heading, up.silent, up.link) if up else (0.0, None, False, False, False)
        self.silent |= tag in SILENT
        self.link |= tag == "a"
        self.heading |= len(tag) == 2 and tag[0] == "h" and tag[1].isdigit()
        against = 0.0
        if tag in TAGS_HERE:
            self.strength = 2.0
        elif tag in TAGS_AWAY:
            # A header inside an article holds its title and by-line.
            against = 0.5 if tag == "header" and self.scope and self.scope.strength >= 2.0 else MUCH
        for name, a, b, c in _ATTRIBUTE.findall(attributes) if attributes else ():
            name, value = name.lower(), a or b or c
            if name in ("class", "id", "itemprop"):
                if tag not in ("body", "html", "article", "main") or (tag == "article" and self.scope):  # an article in another can be a comment
                    much, here = said_by(value)
                    # In an article a doubtful word rather names a part of it.
                    against = max(against, much / 2 if much == LITTLE and self.scope and self.scope.strength >= 2.0 else much)
                    if here:
                        self.strength = max(self.strength, 1.0)
            elif name == "role":
                if value.lower() in _ROLES_AWAY:
                    against = MUCH
                elif value.lower() in ("main", "article"):
                    self.strength = 2.0
            elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and _HIDING.search(value)):
                self.silent = True
        self.away = min(MUCH, self.away + against)
        if self.strength and self.away < MUCH and (not self.scope or self.strength >= self.scope.strength):
            self.scope = self


def blocks_of(page: str) -> list[Block]:
    """The blocks of a page, in order."""
    root = element = Element("", None, "")
    blocks: list[Block] = []
    parts: list[str] = []
    linked = 0
    opened: dict[str, int] = {}  # open elements of each block tag

    def flush(owner: Element) -> None:
        nonlocal linked
        if parts:
            text = _SPACE.sub(" ", "".join(parts)).strip()
            if text:
                blocks.append(Block(text, linked, owner))
            parts.clear()
        linked = 0

    def add(data: str) -> None:
        nonlocal linked
        if data and not element.silent:
            data = html.unescape(data) if "&" in data else data
            parts.append(data)
            if element.link:
                linked += len(data.strip())

    def close(last: Element) -> None:
        """Closes an element and all in it."""
        nonlocal element
        while element is not last.parent:
            counts = opened if element.block is element else element.block.inline
            counts[element.tag] -= 1
            element = element.parent

    def nearest(tag: str) -> Element | None:
        """The innermost open element of a tag; an inline end tag doesn't reach beyond its block. Only looked for where there is one."""
        if not (opened if tag in BLOCKS else element.block.inline).get(tag):
            return None
        e = element
        while e.tag != tag:
            e = e.parent
        return e

    tags, at = Tags(page), 0
    while (found := tags.next(at)) is not None:
        begin, end, slash, tag, attributes = found
        add(page[at:begin])
        at = end
        if not tag:
            continue
        tag = tag.lower()
        if tag in BLOCKS:
            flush(element.block)
        if slash:
            if e := nearest(tag):
                close(e)
            continue
        if tag in _P_ENDS and element.block.tag == "p":
            close(element.block)
        if tag in CLOSES and (e := element.ended[CLOSES[tag]]):
            close(e)
        if tag in VOID or attributes.endswith("/") and tag not in BLOCKS and tag not in SILENT:
            continue
        if tag in ("script", "style", "textarea", "title", "iframe", "noscript"):  # raw text up to its own end tag
            until = _RAW[tag].search(page, at)
            at = until.end() if until else len(page)
            continue
        element = Element(tag, element, attributes)
        counts = opened if tag in BLOCKS else element.block.inline
        counts[tag] = counts.get(tag, 0) + 1
    add(page[at:])
    flush(element.block)
    return blocks


def log_odds(block: Block, scoped: bool) -> float:
    """Of a block being content, by itself. scoped: the page has an element for its article."""
    share = min(1.0, block.linked / max(1, len(block.text)))
    inside = block.scope is not None and block.scope.strength >= 2.0
    text = (-1.1 if scoped else 0.1) + 2.6 * min(block.words, 25) / 25 + (0.6 if block.heading else 0.0) + (0.8 if block.text[-1] in ".!?:;\"”»…" else 0.0)
    return text - (2.2 if inside else 3.0) * share * share - block.away - (4.0 if scoped and not inside else 0.0)


def minimum_cut(source: list[float], sink: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """For nodes with capacities from the source and to the sink, and edges of a capacity both ways: whether each is on the source's side of a least cut.

    Augments along shortest paths in phases (blocking flows); a node's direct flow goes first.
    """
    n = len(source)
    out: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    room: list[float] = []

    def edge(a: int, b: int, there: float, back: float) -> None:
        out[a].append(len(to))
        to.append(b)
        room.append(there)
        out[b].append(len(to))
        to.append(a)
        room.append(back)

    s, t = n, n + 1
    for k in range(n):
        direct = min(source[k], sink[k])
        if source[k] > direct:
            edge(s, k, source[k] - direct, 0.0)
        elif sink[k] > direct:
            edge(k, t, sink[k] - direct, 0.0)
    for a, b, c in edges:
        edge(a, b, c, c)
    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        queue = deque([s])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if room[e] > 1e-9 and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[t] < 0:
            # What the sink doesn't reach is on the source's side: without evidence a block is content.
            behind = [False] * (n + 2)
            behind[t] = True
            queue = deque([t])
            while queue:
                b = queue.popleft()
                for e in out[b]:
                    if room[e ^ 1] > 1e-9 and not behind[to[e]]:
                        behind[to[e]] = True
                        queue.append(to[e])
            return [not x for x in behind[:n]]
        nxt = [0] * (n + 2)
        path: list[int] = []
        a = s
        while True:
            if a == t:
                flow = min(room[e] for e in path)
                cut = 0
                for k, e in enumerate(path):
                    room[e] -= flow
                    room[e ^ 1] += flow
                for k, e in enumerate(path):
                    if room[e] <= 1e-9:
                        cut = k
                        break
                a = to[path[cut] ^ 1]
                del path[cut:]
                continue
            moved = False
            while nxt[a] < len(out[a]):
                e = out[a][nxt[a]]
                if room[e] > 1e-9 and level[to[e]] == level[a] + 1:
                    path.append(e)
                    a = to[e]
                    moved = True
                    break
                nxt[a] += 1
            if not moved:
                if a == s:
                    break
                e = path.pop()
                a = to[e ^ 1]
                nxt[a] += 1


def label(blocks: list[Block], near: float = 0.5, kin: float = 0.4, hold: float = 1.6) -> list[bool]:
    """Whether each block is content. near, kin, hold: capacities of the edges between neighbours, to the parents' node and to the element that holds the article."""
    scoped = any(b.scope and b.scope.strength >= 2.0 and not b.away for b in blocks)
    odds = [log_odds(b, scoped) for b in blocks]
    around = [b.parent.parent or b.parent for b in blocks]
    # Neighbours in page order, whatever they look like; half as close where they lie under different parents.
    edges = [(k - 1, k, near if around[k - 1] is around[k] else near / 2) for k in range(1, len(blocks))]
    numbers: dict[int, int] = {}

    def node(element: Element, capacity: float) -> int:
        if (number := numbers.get(id(element))) is None:
            number = numbers[id(element)] = len(odds)
            odds.append(capacity)
        return number

    for k, b in enumerate(blocks):
        if b.scope:
            at = node(b.scope, 3.0)
            if b.scope.strength >= 2.0:  # holds the article by its name: never on the other side itself, whatever is in it
                odds[at] += hold
            edges.append((k, at, hold * b.scope.strength / 2))
        if around[k] is not b.scope:
            edges.append((k, node(around[k], 0.0), kin))
    return minimum_cut([max(x, 0.0) for x in odds], [max(-x, 0.0) for x in odds], edges)[: len(blocks)]


def main_text(page: str | None) -> str:
    """The article of a page: its blocks in order, joined by line ends."""
    if not page:
        return ""
    blocks = blocks_of(page)
    return "\n".join(b.text for b, content in zip(blocks, label(blocks)) if content) if blocks else ""


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """key, url, text and n_chars (code points) of each row of pages."""
    kinds = [f"{c} {pages.schema[c].dataType.simpleString()}" for c in (key, url)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p.as_py()) for p in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [key, url, "text", "n_chars"])

    return pages.select(F.col(key), F.col(url), F.col(page)).mapInArrow(run, ", ".join([*kinds, "text string", "n_chars long"]))


def query(spark, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
