"""Operator 9, HTML extraction by minimum-cut labelling.

A page is read into blocks of text (runs between block-level tags) with their
place in the tree.  A small classifier turns each block's surroundings and
shape into a cost: its capacity to the source (content) or to the sink
(boilerplate); certain boilerplate has no limit to the sink.  Smoothness edges tie neighbouring blocks and blocks of the
same container, more strongly the closer they are in the tree.  The
minimum cut separates content from boilerplate: sure blocks stay what they
are, doubtful ones follow the company they keep.

A page is one row and is read in one pass; edges are at most two a block.
Blocks whose own capacity exceeds all their edges are on their side in every
minimum cut; they are fixed first, which leaves few or none to the max-flow.
"""

from __future__ import annotations

import html as _html
import math
import re
from collections import deque
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import importable

BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer
form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th
thead tr ul""".split())
RAW = frozenset("script style noscript textarea iframe title".split())  # raw text: without a close, up to the page's end
SKIP = frozenset("template select svg math object canvas button audio video".split())  # ordinary elements that are certain boilerplate
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BAD_TAG = {"nav": -9.0, "footer": -9.0, "aside": -9.0, "form": -9.0, "menu": -9.0, "dialog": -9.0, "header": -7.0, "head": -9.0, "fieldset": -9.0}
GOOD_TAG = {"article": 4.0, "main": 3.0}
BAD_ROLE = frozenset("navigation banner contentinfo complementary search menu menubar toolbar dialog alertdialog alert form".split())
BAD_NAME = frozenset("""ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs byline comment comments commentlist
consent cookie cookies disclaimer disqus dropdown footer footnav gdpr hidden login masthead menu menubar modal nav navbar navigation newsletter
notice notification outbrain overlay pagination pager paywall popup popular promo promoted promotion recommended recommendations related replies respond
rail search share sharing sidebar sidenav signup skip social sponsor sponsored subscribe subscription taboola tags teaser toc toolbar topbar
trending warning widget widgets""".split())
GOOD_NAME = frozenset("article articlebody body content entry maincontent post postbody story text".split())
# A quote opens a value only behind "=", and the value ends at the next such quote, however far; a quote that the page never closes is
# an ordinary character, so its value ends as an unquoted one does.  Nothing is read twice: only a page's last quote can lack its close.
VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s>]*+)"""
TAG = re.compile(rf"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:=\s*+{VALUE}|[^>=]++)*+)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""", re.S)
ATTR = re.compile(rf"""([^\s/>=]++)(?:\s*+=\s*+({VALUE}))?""")
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
# names of what others wrote or what leads elsewhere: an <article> in there is a comment, an advert or a teaser
OTHERS = frozenset("""ad ads advert adverts advertisement advertising adsense comment comments commentlist disqus outbrain popular promo promoted
promotion recommended recommendations related replies respond sponsor sponsored taboola teaser trending""".split())
WRAP = frozenset("col column container grid holder inner layout outer row wrap wrapper wrapping".split())
PART = WRAP | frozenset("area bar block box button buttons cell form group icon icons item items link links list panel region section slot".split())
COLUMNS = frozenset("content main page".split())
WITHOUT = frozenset("backface has no not overflow with without".split())
STATE = frozenset("active closed enabled free layout off on open page template visible".split())
SURE = -9.0  # certain boilerplate: joined to the sink without limit, whatever its length, place and neighbours
SMOOTH, SIBLING = 1.2, 0.8


@lru_cache(1 << 14)
def name_kind(name: str) -> int:
    """A class or id: 0 says nothing, 1 names a boilerplate part, 2 one of OTHERS.  The whole name, its first or its last
    word says so, the last before words such as box or list.  "has-sidebar", "comments-open" and "content-sidebar-wrap" are of the page."""
    words = [w.lower() for w in NAME.findall(name)]
    if name.lower() not in BAD_NAME:
        if not BAD_NAME.intersection(words) or words[-1] in STATE or WITHOUT.intersection(words[:-1]) or words[0] in COLUMNS and words[-1] in WRAP:
            return 0
        while len(words) > 1 and words[-1] in PART:
            words.pop()
        words = [w for w in (words[0], words[-1]) if w in BAD_NAME]
    else:
        words = [name.lower()]
    return max((2 if w in OTHERS else 1 for w in words), default=0)


def _attributes(tag: str, raw: str) -> tuple[float, int, float, bool]:
    """What an element's attributes say: certain boilerplate, kind of a boilerplate name, content, main part of the page."""
    bad, named, good, main = 0.0, 0, 0.0, tag == "main"
    for key, value in ATTR.findall(raw):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            bad = SURE
        elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            bad = SURE
        elif key == "role" and value.lower() in BAD_ROLE:
            bad = SURE
        elif key == "role" and value.lower() == "main":
            main = True
        elif key in ("class", "id"):
            for name in value.split():
                words = {w.lower() for w in NAME.findall(name)} | {name.lower()}
                if not words & BAD_NAME:
                    good = 2.0 if words & GOOD_NAME else good
                elif tag not in ("body", "html", "main", "article"):
                    named = max(named, name_kind(name))
                elif words & GOOD_NAME:
                    good = 2.0
    return bad, 0 if main else named, good if not (bad or named) else 0.0, main


class _Page:
    """Blocks of a page: text, cost to be content, parent node."""

    def __init__(self, source: str):
        self.parent, self.depth = [-1], [0]
        self.blocks: list[tuple[str, float, int]] = []
        # tag, node, worst cost around, best, kind of the worst name around, and of that within the article or main part
        self.stack: list[tuple[str, int, float, float, int, int]] = [("", 0, 0.0, 0.0, 0, 0)]
        self.names: list[tuple[int, int]] = []
        self.plain = False  # the page has an article or main part with text outside all boilerplate names
        self.buffer: list[str] = []
        self.linked = 0
        self.in_link = 0
        self.skipped = 0  # open SKIP elements
        self._read(source)
        # A name is certain, too.  But if all articles lie in parts with boilerplate names, such a part is the page's layout:
        # there only names within the article count, and those of OTHERS.
        self.blocks = [(text, -math.inf if names[not self.plain] else cost, node) for (text, cost, node), names in zip(self.blocks, self.names)]

    def _end_block(self) -> None:
        if self.buffer:
            text = " ".join("".join(self.buffer).split())
            if text:
                tag, node, bad, good, named, within = self.stack[-1]
                near = next((t for t, *_ in reversed(self.stack) if t in BLOCK), "")
                self.blocks.append((text, self._cost(text, near, bad, good), node))
                self.names.append((named, within))
                self.plain |= good >= 3.0 and bad > SURE and not named
            self.buffer = []
        self.linked = 0

    def _cost(self, text: str, tag: str, bad: float, good: float) -> float:
        if bad <= SURE:
            return -math.inf
        words = text.count(" ") + 1
        density = min(1.0, self.linked / max(1, len(text)))
        cost = -1.2 + 0.7 * math.log(words) - 5.0 * density + good
        if text[-1] in ".!?…:;\"'»”’)" and words > 3:
            cost += 0.7
        if tag == "p" or tag in ("blockquote", "pre"):
            cost += 1.0
        elif len(tag) == 2 and tag[0] == "h" and tag[1].isdigit():
            cost += 0.6
        elif tag == "li":
            cost -= 0.6
        return cost + bad

    def _text(self, raw: str) -> None:
        if raw and not self.skipped:
            text = _html.unescape(raw) if "&" in raw else raw
            self.buffer.append(text)
            if self.in_link:
                self.linked += len(text.strip())

    def _open(self, tag: str, raw: str) -> None:
        _, node, bad, good, named, within = self.stack[-1]
        sure, name, content, main = _attributes(tag, raw)
        if main:
            named = within = 0
        elif tag == "article" and within < 2:
            within = 0
        if tag == "header" and good >= 3.0:
            pass  # an article's own header holds its headline
        else:
            bad = min(bad, BAD_TAG.get(tag, 0.0))
        bad = min(bad, sure)
        good = max(good, GOOD_TAG.get(tag, 0.0), content, GOOD_TAG["main"] if main else 0.0)
        if tag in BLOCK:
            self.parent.append(node)
            self.depth.append(self.depth[node] + 1)
            node = len(self.parent) - 1
        if tag == "a":
            self.in_link += 1
        self.skipped += tag in SKIP
        self.stack.append((tag, node, bad, good, max(named, name), max(within, name)))

    def _pop(self, to: int) -> None:
        for tag, *_ in self.stack[to:]:
            if tag == "a":
                self.in_link -= 1
            self.skipped -= tag in SKIP
        del self.stack[to:]

    def _find(self, tag: str, stop) -> int:
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i][0] == tag:
                return i
            if stop(self.stack[i][0]):
                return 0
        return 0

    @staticmethod
    def _tags(source: str) -> list[tuple[int, int, str, str, str]]:
        """Tags of the page: from, to, "/" if closing, name, attributes.  A raw-text element is one tag, comments are of no name."""
        out, at, end = [], 0, len(source)
        while at < end and (m := TAG.search(source, at)):
            at, tag = m.end(), (m[2] or "").lower()
            if tag in RAW and not m[1] and not m[3].endswith("/"):
                close = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(source, at)
                at = close.end() if close else end
            out.append((m.start(), at, m[1] or "", tag, m[3] or ""))
        return out

    @staticmethod
    def _skips(tags) -> dict[int, int]:
        """Places of the SKIP elements that are closed within their parent -> place of their close."""
        out: dict[int, int] = {}
        stack: list[tuple[str, int]] = []
        opened: dict[str, int] = {}
        for i, (_, _, closing, tag, raw) in enumerate(tags):
            if tag not in SKIP and tag not in BLOCK or tag in VOID:
                continue
            if not closing:
                if tag in BLOCK or not raw.endswith("/"):
                    stack.append((tag, i))
                    opened[tag] = opened.get(tag, 0) + 1
            elif opened.get(tag):
                while True:
                    name, j = stack.pop()
                    opened[name] -= 1
                    if name == tag:
                        break
                if tag in SKIP:
                    out[j] = i
        return out

    def _read(self, source: str) -> None:
        tags = self._tags(source)
        closes = self._skips(tags) if any(t[3] in SKIP for t in tags) else {}
        at = i = 0
        while i < len(tags):
            start, end, closing, tag, raw = tags[i]
            self._text(source[at:start])
            at = end
            i += 1
            if not tag:
                continue
            if self.skipped and tag in ("option", "optgroup"):
                continue
            if closing:
                self._close(tag)
                continue
            if tag in RAW or tag in SKIP:
                if tag not in ("svg", "math", "object"):
                    self.buffer.append(" ")
                if tag in SKIP and not raw.endswith("/"):
                    if i - 1 in closes:  # all of it is left out, with what is nested in it
                        i = closes[i - 1] + 1
                        at = tags[i - 1][1]
                    else:  # never closed: ends with its parent, or before the next block
                        self._open(tag, "")
                continue
            if tag == "br":
                self.buffer.append(" ")
                continue
            if tag in BLOCK:
                if self.skipped:
                    self._pop(next(k for k, e in enumerate(self.stack) if e[0] in SKIP))
                self._end_block()
                # open paragraphs end at the next block, list and table parts at the next of their kind
                if k := self._find("p", lambda t: t in BLOCK):
                    self._pop(k)
                if tag in ("li", "dt", "dd", "option", "tr", "td", "th"):
                    same = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}.get(tag, (tag,))
                    for s in same:
                        if k := self._find(s, lambda t: t in ("ul", "ol", "dl", "table", "menu", "select")):
                            self._pop(k)
            if tag in VOID or raw.endswith("/") and tag not in BLOCK:
                continue
            self._open(tag, raw)
        self._text(source[at:])
        self._end_block()

    def _close(self, tag: str) -> None:
        if tag in BLOCK:
            self._end_block()
            if i := self._find(tag, lambda t: False):
                self._pop(i)
        elif i := self._find(tag, lambda t: t in BLOCK):
            self._pop(i)

    def apart(self, a: int, b: int) -> int:
        """Steps between two nodes of the tree, up to 8."""
        steps = 0
        while a != b and steps < 8:
            if self.depth[a] >= self.depth[b]:
                a = self.parent[a]
            else:
                b = self.parent[b]
            steps += 1
        return steps

    def edges(self) -> dict[tuple[int, int], float]:
        """Smoothness: neighbours in the page, and the last block before in the same container."""
        out: dict[tuple[int, int], float] = {}
        last: dict[int, int] = {}
        for i, (_, _, node) in enumerate(self.blocks):
            if i:
                out[i - 1, i] = SMOOTH / (1 + 0.5 * self.apart(self.blocks[i - 1][2], node))
            around = self.parent[node] if node else 0
            if around in last:
                j = last[around]
                out[j, i] = out.get((j, i), 0.0) + SIBLING / (i - j)
            last[around] = i
        return out


def min_cut(costs: list[float], edges: dict[tuple[int, int], float]) -> list[bool]:
    """Which nodes are on the source's side of a minimum cut.  Node i has capacity costs[i]
    from the source if positive, -costs[i] to the sink if negative; edges count both ways.  Ties go to the sink."""
    near: list[dict[int, float]] = [{} for _ in costs]
    for (a, b), w in edges.items():
        near[a][b] = near[a].get(b, 0.0) + w
        near[b][a] = near[b].get(a, 0.0) + w
    cost, side = list(costs), [None] * len(costs)
    todo = deque(range(len(costs)))
    while todo:  # sure nodes, and those that become sure through them
        i = todo.popleft()
        if side[i] is not None or abs(cost[i]) <= sum(near[i].values()):
            if side[i] is None and not near[i]:
                side[i] = cost[i] > 0
            continue
        side[i] = cost[i] > 0
        for j, w in near[i].items():
            del near[j][i]
            cost[j] += w if side[i] else -w
            todo.append(j)
        near[i] = {}
    left = [i for i, s in enumerate(side) if s is None]
    if not left:
        return side
    # max-flow by shortest augmenting paths (Dinic) over the rest
    number = {i: k for k, i in enumerate(left)}
    s, t = len(left), len(left) + 1
    graph: list[list[list]] = [[] for _ in range(len(left) + 2)]  # [to, capacity, place of the reverse edge]

    def add(a, b, forth, back):
        graph[a].append([b, forth, len(graph[b])])
        graph[b].append([a, back, len(graph[a]) - 1])

    for i in left:
        if cost[i] > 0:
            add(s, number[i], cost[i], 0.0)
        elif cost[i] < 0:
            add(number[i], t, -cost[i], 0.0)
        for j, w in near[i].items():
            if i < j:
                add(number[i], number[j], w, w)
    tiny = 1e-12
    while True:
        level = [-1] * len(graph)
        level[s], queue = 0, deque([s])
        while queue:
            a = queue.popleft()
            for b, c, _ in graph[a]:
                if c > tiny and level[b] < 0:
                    level[b] = level[a] + 1
                    queue.append(b)
        if level[t] < 0:
            break
        place = [0] * len(graph)
        path: list[tuple[int, int]] = []
        a = s
        while True:  # blocking flow, without recursion
            if a == t:
                push = min(graph[x][k][1] for x, k in path)
                for x, k in path:
                    e = graph[x][k]
                    e[1] -= push
                    graph[e[0]][e[2]][1] += push
                cut = next(n for n, (x, k) in enumerate(path) if graph[x][k][1] <= tiny)
                a = path[cut][0]
                del path[cut:]
                continue
            while place[a] < len(graph[a]):
                b, c, _ = graph[a][place[a]]
                if c > tiny and level[b] == level[a] + 1:
                    break
                place[a] += 1
            else:
                if a == s:
                    break
                a, k = path.pop()
                place[a] += 1
                continue
            path.append((a, place[a]))
            a = b
    for i in left:
        side[i] = level[number[i]] >= 0
    return side


def extract(source: str | None) -> str:
    """The main text of a page: its content blocks in page order, joined by line
    ends.  White space inside a block is one space; ``br`` is white space.  Null, empty or
    markup alone: empty.  Unclosed tags, comments and raw-text elements end with the page; an unclosed quote opens no value, and
    buttons, media, drawings and the like that are not closed within their parent end with it, or before the next block."""
    if not source:
        return ""
    page = _Page(source)
    if not page.blocks:
        return ""
    side = min_cut([c for _, c, _ in page.blocks], page.edges())
    return "\n".join(text for (text, _, _), keep in zip(page.blocks, side) if keep)


def main_text(pages: DataFrame, html: str = "html", name: str = "text") -> DataFrame:
    """Adds the main text of every page (and replaces a column of that name)."""
    importable(pages.sparkSession)

    @F.pandas_udf("string")
    def run(sources: pd.Series) -> pd.Series:
        return pd.Series([extract(s) for s in sources], dtype=object)

    return pages.withColumn(name, run(F.col(f"`{html}`")))


def query(pages: DataFrame) -> DataFrame:
    return main_text(pages.select("page_id", "url", "html")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
