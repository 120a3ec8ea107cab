"""Main text of web pages by minimum-cut labelling.

A page is cut into text blocks at its block-level tags.  Every block gets a
score from a linear classifier over its place in the document and its text
(positive: content).  The scores are the terminal capacities of a flow
network; neighbouring blocks, and blocks that are near in the element tree,
are tied by smoothness edges.  The minimum cut is the cheapest labelling: it
keeps a short line inside an article and drops a long one inside a sidebar.

Blocks whose score outweighs all their edges have their label in every
minimum cut, so they are settled first; Dinic's algorithm labels the rest.
"""

from __future__ import annotations

import html
import re
from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odgraph.llm.common import slices, utf8

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg select option object canvas "
                "audio video noembed noframes xmp".split())
BLOCKS = frozenset("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset "
                   "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav "
                   "ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCKS - {"br"}
#: Elements whose text is something to press.
CONTROLS = frozenset(("a", "button"))
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
            "th": {"td", "th"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"},
          "th": {"tr", "table"}}
# What elements, classes, ids and roles say about their text.
BOILERPLATE_TAGS = frozenset("nav aside header footer form menu dialog search head fieldset".split())
BOILERPLATE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense adslot adbox sponsor sponsored sponsors promo promotion promoted "
    "banner banners nav navbar navigation navi menu menus topbar toolbar breadcrumb breadcrumbs pagination pager "
    "sidebar sidebars aside complementary widget widgets footer foot contentinfo colophon header masthead "
    "cookie cookies consent gdpr notice notices notification notifications popup modal overlay dialog "
    "newsletter subscribe subscription signup login signin form forms share sharing social "
    "related recommended recommendations trending outbrain taboola comment comments commentlist respond disqus "
    "replies reply hidden".split())
#: Names that boilerplate and articles share: evidence that a block's text may outweigh.
DOUBTFUL_NAMES = frozenset("alert alerts warning register search follow popular discussion copyright legal disclaimer skip".split())
#: Names by which an article element is not the page's article.
OTHER_ARTICLES = frozenset("comment comments reply replies respond related recommended promo ad ads advert sponsored "
                           "teaser".split())
CONTENT_NAMES = frozenset("article articlebody content post entry story main body text maincontent postcontent".split())

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<!--|<[!?/]""")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class _Element:
    __slots__ = ("tag", "parent", "depth", "negative", "doubtful", "positive", "names_only", "chars", "hidden")

    def __init__(self, tag, parent, attributes=""):
        self.tag, self.parent = tag, parent
        self.depth = parent.depth + 1 if parent else 0
        self.chars = 0
        values = {}
        if attributes and not attributes.isspace():
            for name, a, b, c in _ATTRIBUTE.findall(attributes):
                values.setdefault(name.lower(), a or b or c)
        names = {x.lower() for k in ("class", "id", "role") for x in _NAME.findall(html.unescape(values.get(k, "")))}
        style = values.get("style", "").replace(" ", "").lower()
        self.hidden = "hidden" in values or values.get("aria-hidden") == "true" or "display:none" in style
        if tag in ("article", "main"):
            bad = bool(names & OTHER_ARTICLES)
        else:
            bad = tag not in ("html", "body") and bool(names & BOILERPLATE_NAMES)
        self.names_only = bad and tag not in BOILERPLATE_TAGS and not self.hidden
        self.negative = bad or tag in BOILERPLATE_TAGS or self.hidden
        self.doubtful = not self.negative and tag not in ("html", "body", "article", "main") and bool(names & DOUBTFUL_NAMES)
        self.positive = not self.negative and (tag in ("article", "main") or bool(names & CONTENT_NAMES))


class _Block:
    __slots__ = ("element", "parts", "chars", "linked", "text")

    def __init__(self, element):
        self.element, self.parts, self.chars, self.linked = element, [], 0, 0


def parse(page: str) -> list[_Block]:
    """Text blocks of a page in page order, none of them empty."""
    root = _Element("html", None)
    stack = [root]
    blocks: list[_Block] = []
    block = _Block(root)
    links = 0
    at, end = 0, len(page)

    def add(raw):
        nonlocal links
        text = html.unescape(raw) if "&" in raw else raw
        block.parts.append(text)
        size = len(text)
        block.chars += size
        if links:
            block.linked += size

    def new_block():
        nonlocal block
        if block.parts:
            text = " ".join("".join(block.parts).split())
            if text:
                block.text = text
                blocks.append(block)
        block = _Block(stack[-1])

    def pop(to):
        nonlocal links
        while len(stack) > to:
            if stack.pop().tag in CONTROLS:
                links -= 1

    while at < end:
        tag = _TAG.search(page, at)
        if tag is None:
            add(page[at:])
            break
        if tag.start() > at:
            add(page[at:tag.start()])
        at = tag.end()
        name = tag[2] or tag[5]
        if name is None:
            if tag[0] == "<!--":
                close = page.find("-->", at)
                at = end if close < 0 else close + 3
            else:
                close = page.find(">", at)
                at = end if close < 0 else close + 1
            continue
        name = name.lower()
        if tag[1] or tag[4]:  # an end tag
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == name:
                    if name in BLOCKS:
                        new_block()
                    pop(i)
                    if name in BLOCKS:
                        block = _Block(stack[-1])
                    break
                if stack[i].tag in ("td", "th", "table", "article", "main", "body") and name not in BLOCKS:
                    break
            continue
        attributes = tag[3] if tag[2] else tag[6]
        if name in RAW:
            if not attributes.endswith("/"):
                close = re.compile(f"</{re.escape(name)}\\b[^>]*>", re.I).search(page, at)
                at = close.end() if close else end if name in ("script", "style") else at
            continue
        if name in BLOCKS:
            new_block()
            if name in CLOSES_P:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == "p":
                        pop(i)
                        break
                    if stack[i].tag in CLOSES_P:
                        break
            if name in SIBLINGS:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag in SIBLINGS[name]:
                        pop(i)
                        break
                    if stack[i].tag in SCOPES[name]:
                        break
            if name == "body":
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == "head":
                        pop(i)
                        break
        if name not in VOID and not attributes.endswith("/") and name not in ("html",):
            stack.append(_Element(name, stack[-1], attributes))
            links += name in CONTROLS
        if name in BLOCKS:
            block = _Block(stack[-1])
    new_block()
    return blocks


def scores(blocks: list[_Block]) -> list[float]:
    """The classifier: evidence of the elements around a block, its length,
    links and sentence marks."""
    for b in blocks:
        e = b.element
        while e is not None:
            e.chars += len(b.text)
            e = e.parent
    # classes of elements around the main article say nothing about it
    mains = {}
    for b in blocks:
        e = b.element
        while e is not None:
            if e.positive and e.tag in ("article", "main"):
                mains[id(e)] = e
            e = e.parent
    around = set()
    if mains:
        e = max(mains.values(), key=lambda e: (e.chars, -e.depth)).parent
        while e is not None:
            around.add(id(e))
            e = e.parent
    known: dict[int, tuple[float, float]] = {}

    def place(e):
        chain = []
        while e is not None and id(e) not in known:
            chain.append(e)
            e = e.parent
        got, doubt = known[id(e)] if e is not None else (0.0, 0.0)
        for e in reversed(chain):
            if e.negative and not (e.names_only and id(e) in around):
                got = -8.0
            elif got > -8.0:
                if e.positive:
                    got = max(got, 4.0 if e.tag in ("article", "main") else 2.0)
                if e.doubtful and id(e) not in around:
                    doubt = -4.0
            known[id(e)] = got, doubt
        return got + doubt

    out = []
    for b in blocks:
        words = b.text.count(" ") + 1
        share = b.linked / max(b.chars, 1)
        s = place(b.element)
        s += min(words, 40) / 20 - 0.6
        if share > 0.5:
            s -= 2.5 * share
        if b.text[-1] in ".!?…:;\"”»":
            s += 0.3
        if b.element.tag in ("p", "pre", "blockquote") or re.fullmatch("h[1-6]", b.element.tag):
            s += 0.6
        elif b.element.tag == "li":
            s -= 0.3
        if "©" in b.text and words < 40:
            s -= 2.0
        out.append(s)
    return out


def ties(blocks: list[_Block]) -> list[tuple[int, int, float]]:
    """Smoothness edges: to the next block, weaker the farther they are in the
    element tree, and to the next block of the same parent element.  Two of them
    weigh about as much as the text of a block, so its neighbours decide what the
    text leaves open."""
    out = []
    last: dict[int, int] = {}
    for j, b in enumerate(blocks):
        parent = id(b.element.parent)
        if j:
            x, y, steps = blocks[j - 1].element, b.element, 0
            while x is not y:
                if x.depth >= y.depth:
                    x = x.parent
                else:
                    y = y.parent
                steps += 1
            out.append((j - 1, j, 2.0 / (1 + steps) if steps <= 6 else 0.2))
        i = last.get(parent)
        if i is not None and i != j - 1:
            out.append((i, j, 0.6))
        last[parent] = j
    return out


def minimum_cut(score: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Labels that minimise: score lost by labelling against its sign, plus the
    weight of every edge whose ends differ.  A tie is content."""
    n = len(score)
    score = list(score)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for i, j, w in edges:
        near[i][j] = near[i].get(j, 0.0) + w
        near[j][i] = near[j].get(i, 0.0) + w
    label: list[bool | None] = [None] * n
    todo = deque(range(n))
    while todo:  # settled: the score outweighs all edges to unsettled neighbours
        i = todo.popleft()
        if label[i] is not None or abs(score[i]) <= sum(near[i].values()):
            continue
        label[i] = score[i] > 0
        for j, w in near[i].items():
            score[j] += w if label[i] else -w
            del near[j][i]
            if label[j] is None:
                todo.append(j)
        near[i] = {}
    free = [i for i in range(n) if label[i] is None]
    if free:
        number = {i: k for k, i in enumerate(free)}
        source, sink = len(free), len(free) + 1
        graph: list[list[int]] = [[] for _ in range(len(free) + 2)]
        to: list[int] = []
        room: list[float] = []

        def edge(a, b, forth, back):
            graph[a].append(len(to))
            to.append(b)
            room.append(forth)
            graph[b].append(len(to))
            to.append(a)
            room.append(back)

        for i in free:
            if score[i] > 0:
                edge(source, number[i], score[i], 0.0)
            elif score[i] < 0:
                edge(number[i], sink, -score[i], 0.0)
            for j, w in near[i].items():
                if i < j:
                    edge(number[i], number[j], w, w)
        boiler = _reaches_sink(graph, to, room, source, sink)
        for i in free:
            label[i] = number[i] not in boiler
    return label


def _reaches_sink(graph, to, room, source, sink) -> set[int]:
    """Dinic's maximum flow; the nodes from which the sink can still be reached."""
    tiny = 1e-9
    while True:
        level = {source: 0}
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in graph[a]:
                if room[e] > tiny and to[e] not in level:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if sink not in level:
            break
        turn = [0] * len(graph)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                cut = next(k for k, e in enumerate(path) if room[e] <= tiny)
                a = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while turn[a] < len(graph[a]):
                e = graph[a][turn[a]]
                if room[e] > tiny and level.get(to[e], -1) == level[a] + 1:
                    break
                turn[a] += 1
            if turn[a] < len(graph[a]):
                path.append(graph[a][turn[a]])
                a = to[path[-1]]
            elif path:
                e = path.pop()
                a = to[e ^ 1]
                turn[a] += 1
            else:
                break
    back = {sink}
    queue = deque([sink])
    while queue:
        b = queue.popleft()
        for e in graph[b]:
            a = to[e]
            if room[e ^ 1] > tiny and a not in back:
                back.add(a)
                queue.append(a)
    return back


def main_text(page: str | None) -> str:
    """Blocks labelled content, in page order, joined by one blank."""
    if not page:
        return ""
    blocks = parse(page)
    label = minimum_cut(scores(blocks), ties(blocks))
    return " ".join(b.text for b, content in zip(blocks, label) if content)


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
            carry: tuple[str, ...] = ("url",)) -> DataFrame:
    """``(id_col, *carry, text, n_chars)`` for every row of ``pages``.

    Null and empty pages, and pages without content, have an empty text;
    repeated rows and null ids are returned as they are; nothing of a long
    page is cut off; bytes that are not UTF-8 are read as U+FFFD; columns of other
    names are not read.
    """
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in (id_col, *carry)]).alias("payload"),
                        F.col(html_col).cast("string").alias("html"))

    def read(batches):
        for batch in batches:
            for part in slices(batch, 1):
                texts = [main_text(x.decode("utf-8", "replace") if x is not None else None) for x in utf8(part.column(1))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                    ["payload", "text", "n_chars"])

    found = rows.mapInArrow(read, T.StructType([
        T.StructField("payload", rows.schema["payload"].dataType),
        T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]))
    return found.select(*[F.col("payload")[c].alias(c) for c in (id_col, *carry)], "text", "n_chars")
