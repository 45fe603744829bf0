"""Main text of web pages by minimum-cut labelling of their elements and text blocks.

A page becomes a graph. Its nodes are text blocks and the elements that hold them. A logistic classifier over the
words and links of a block gives its log odds of being content; elements that say what they are (``nav``, ``article``,
a paragraph, a class of adverts, a list of links) get odds for each block below them, and the root gets a weak prior. The odds are
the capacities to source and sink. Every block is tied to its element, every element to its parent, with a weight
for each block below it, and neighbouring blocks to each other. The minimum cut is the labelling of least total cost:
a short line stays because its article does, prose in an advert goes with the advert.

``fit_weights`` fits the classifier on blocks whose ancestors say what they are, on at most ``SAMPLE_PAGES`` different
pages (those of least hash), with the prior weights as centre; without such blocks it returns the prior weights.

Edge cases: NULL or empty html gives an empty text; text outside any tag is a block; unclosed, crossing or cut-off
tags never fail, and hidden elements that are never closed end at the next block; a page without text blocks, or with
boilerplate only, gives an empty text; repeated rows are treated alike; all columns pass through, but ``main_text`` is
replaced.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Tags by what they do.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = set("head script style noscript template svg math iframe object canvas textarea select option button video audio map".split())
IN_HEAD = set("head title base link meta script style noscript template".split())
BOILER_TAGS = set("nav footer aside form menu dialog".split())
BOILER_ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
INLINE = set("""a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp
small span strike strong sub sup time tt u var wbr""".split())
CONTAINERS = set("html body main article section div td th table ul ol dl li blockquote aside nav header footer form figure".split())
# Words in class and id that mark boilerplate, and those that do so only where they are all the name says.
BOILER_WORDS = set("""ad ads adv advert adverts advertisement adsense sponsor sponsored promo promotion banner cookie cookies
consent gdpr popup modal overlay newsletter subscribe subscription signup login nav navbar navigation menu
breadcrumb breadcrumbs footer sidebar share sharing social related recommended comment comments respond replies disqus
widget masthead pagination pager toolbar""".split())
BOILER_ALONE = set("notice alert".split())
COMMENT_WORDS = set("comment comments respond replies disqus".split())
# Fixed values, in thousandths: odds per block of elements, ties per block, and the bound of a block's own odds.
BOILER, ARTICLE, PROSE, LINK_LIST, ROOT, ROOT_BESIDE_ARTICLE = -12000, 12000, 1000, -9000, 2000, -6000
BLOCK_TIE, MARKED_TIE, PLAIN_TIE, ADJACENT, MOST_ODDS = 6000, 6000, 2500, 400, 4000
# Prior weights: constant, ten words (at most 40), share of links (1 without a letter or digit), end of a sentence.
PRIOR = (-1.0, 0.9, -4.0, 1.0)
MOST_WORDS, SAMPLE_PAGES, PRIOR_STRENGTH = 40, 2000, 20.0

_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_HIDDEN_END = re.compile(r"</(noscript|template|svg|math|iframe|object|canvas|select|option|button|video|audio|map)\b", re.I)
_HEADING = re.compile("h[1-6]")


class _Frame:
    """An open element. ``block`` is the nearest element that is not inline, ``mark`` what the nearest marked one says."""

    __slots__ = ("tag", "hidden", "link", "node", "mark", "loose", "block")

    def __init__(self, tag, hidden, link, node, mark, loose, block):
        self.tag, self.hidden, self.link, self.node, self.mark, self.loose = tag, hidden, link, node, mark, loose
        self.block = block or self


class PageReader(HTMLParser):
    """Elements (parent, odds per block, tie per block, tag) and text blocks (text, features, element, mark) of a page."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.elements: list[tuple[int, int, int, str]] = [(-1, 0, 0, "")]
        self.blocks: list[tuple[str, tuple[int, ...], int, int]] = []
        self.stack = [_Frame("", False, False, 0, 0, False, None)]
        self.open: dict[str, list[int]] = {}
        self.ends = Counter(x.lower() for x in _HIDDEN_END.findall(html))
        self.parts: list[str] = []
        self.linked = 0
        self.owner: _Frame | None = None
        last = html.rfind("<")
        cut_off = last >= 0 and ">" not in html[last:] and re.match("[A-Za-z/!?]", html[last + 1:last + 2])
        self.feed(html[:last] if cut_off else html)
        self.close()
        self.flush()

    def handle_starttag(self, tag, attrs):
        if tag not in INLINE:
            self.flush()
            while self.stack[-1].loose:
                self._cut(len(self.stack) - 1)
        if self.open.get("head") and tag not in IN_HEAD:
            self._close_to("head", ())
        if tag in VOID:
            if tag == "br":
                self.handle_data(" ")
            return
        if tag in ("p", "li", "tr", "td", "th", "dt", "dd", "option", "button") or _HEADING.fullmatch(tag):
            self._close_to("p", CONTAINERS)
            if tag != "p":
                self._close_to(tag, CONTAINERS - {tag})
        elif tag in CONTAINERS:
            self._close_to("p", CONTAINERS)
        top = self.stack[-1]
        says = _says(tag, dict(attrs), top.mark)
        hidden, link = top.hidden or tag in HIDDEN, top.link or tag == "a"
        if tag in INLINE:
            frame = _Frame(tag, hidden or says < 0, link, top.node, top.mark, False, top.block)
        else:
            mark = top.mark if top.mark < 0 or not says else says
            tie = MARKED_TIE if top.mark else PLAIN_TIE
            self.elements.append((top.node, mark if mark != top.mark else 0, tie, tag))
            loose = tag in HIDDEN and tag not in IN_HEAD - {"noscript", "template"} and self.ends[tag] == 0
            frame = _Frame(tag, hidden, link, len(self.elements) - 1, mark, loose, None)
        self.open.setdefault(tag, []).append(len(self.stack))
        self.stack.append(frame)

    def updatepos(self, i, j):
        """Line numbers are not needed."""
        return j

    def handle_endtag(self, tag):
        if tag not in INLINE:
            self.flush()
        if tag in self.ends:
            self.ends[tag] -= 1
        self._close_to(tag, ())

    def _close_to(self, tag: str, limit) -> None:
        """Close the innermost open ``tag`` and what it holds, unless an element of ``limit`` lies between."""
        places = self.open.get(tag)
        if places and not any(self.open.get(x) and self.open[x][-1] > places[-1] for x in limit):
            self._cut(places[-1])

    def _cut(self, place: int) -> None:
        for frame in self.stack[place:]:
            self.open[frame.tag].pop()
        del self.stack[place:]

    def handle_data(self, data):
        if self.stack[-1].tag == "head" and not data.isspace():
            self._close_to("head", ())
        top = self.stack[-1]
        if top.hidden:
            return
        if self.owner is None and not data.isspace():
            self.owner = top.block
        self.parts.append(data)
        if top.link:
            self.linked += len(data)

    def flush(self) -> None:
        if self.owner is not None:
            raw = "".join(self.parts)
            words = raw.split()
            text = " ".join(words)
            linked = self.linked / len(raw) if any(map(str.isalnum, text)) else 1.0
            features = (
                min(len(words), MOST_WORDS), round(10 * min(1.0, linked)),
                int(text[-1] in ".!?:;\"'…”»)"),
            )
            self.blocks.append((text, features, self.owner.node, self.owner.mark))
        self.parts, self.linked, self.owner = [], 0, None


def _says(tag: str, attrs: dict, mark: int) -> int:
    """What an element says of its content by itself: ``BOILER``, ``ARTICLE`` or 0."""
    names = {x.lower() for k in ("class", "id") for x in _NAME.findall(attrs.get(k) or "")} if attrs else set()
    if tag in ("article", "main"):
        return BOILER if names & COMMENT_WORDS else ARTICLE
    if tag in BOILER_TAGS or tag == "header" and mark <= 0:
        return BOILER
    if tag in ("html", "body"):
        return 0
    if (attrs.get("role") or "").lower() in BOILER_ROLES:
        return BOILER
    return BOILER if names & BOILER_WORDS or names and names <= BOILER_ALONE else 0


def block_odds(features: tuple[int, ...], weights: tuple[float, ...]) -> int:
    """Log odds in thousandths that a block is content, by what it says and how it is tagged."""
    constant, words, links, ends = weights
    n_words, tenths, end = features
    odds = constant + words * n_words / 10 + links * tenths / 10 + ends * end
    return max(-MOST_ODDS, min(MOST_ODDS, round(1000 * odds)))


def page_graph(page: PageReader, weights: tuple[float, ...] = PRIOR) -> tuple[list[int], dict[tuple[int, int], int]]:
    """Odds of all nodes (blocks, then elements) and the ties between them."""
    n, below, links = len(page.blocks), [0] * len(page.elements), [0] * len(page.elements)
    edges: dict[tuple[int, int], int] = {}
    for i, (_, features, element, _) in enumerate(page.blocks):
        below[element] += 1
        links[element] += features[1] >= 8
        edges[i, n + element] = BLOCK_TIE
        if i:
            edges[i - 1, i] = ADJACENT
    has_article = any(own > 0 for _, own, _, _ in page.elements)
    odds = [block_odds(features, weights) for _, features, _, _ in page.blocks] + [0] * len(page.elements)
    for e in range(len(page.elements) - 1, 0, -1):
        parent, own, tie, tag = page.elements[e]
        if below[e]:
            if not own and tag in ("ul", "ol", "table") and below[e] > 1 and 5 * links[e] >= 4 * below[e]:
                own = LINK_LIST
            elif not own and (tag in ("p", "blockquote", "pre") or _HEADING.fullmatch(tag)):
                own = PROSE
            odds[n + e] = own * below[e]
            edges[n + parent, n + e] = tie * below[e]
            below[parent] += below[e]
            links[parent] += links[e]
    odds[n] = (ROOT_BESIDE_ARTICLE if has_article else ROOT) * below[0]
    return odds, edges


def minimum_cut(odds: list[int], edges: dict[tuple[int, int], int]) -> list[bool]:
    """True for the nodes on the source side of a minimum cut.

    Two exact reductions come first: a node whose own capacity is at least that of all its edges keeps its own side,
    and a node with an edge at least as heavy as all else it has goes with that neighbour. Maximum flow decides the rest.
    """
    near: list[dict[int, int]] = [{} for _ in odds]
    for (a, b), weight in edges.items():
        near[a][b] = near[a].get(b, 0) + weight
        near[b][a] = near[b].get(a, 0) + weight
    pull, total = list(odds), [sum(x.values()) for x in near]
    side: list[bool | None] = [None] * len(odds)
    goes_with = list(range(len(odds)))
    queue = deque(range(len(odds)))
    while queue:
        v = queue.popleft()
        if side[v] is not None or goes_with[v] != v:
            continue
        if not near[v] or abs(pull[v]) >= total[v]:
            side[v] = pull[v] > 0
            for u, weight in near[v].items():
                del near[u][v]
                total[u] -= weight
                pull[u] += weight if side[v] else -weight
                queue.append(u)
            near[v] = {}
        elif len(near[v]) <= 8:
            u = max(near[v], key=near[v].get)
            if 2 * near[v][u] >= abs(pull[v]) + total[v]:
                weight = near[v].pop(u)
                del near[u][v]
                for x, w in near[v].items():
                    del near[x][v]
                    near[x][u] = near[x].get(u, 0) + w
                    near[u][x] = near[u].get(x, 0) + w
                    queue.append(x)
                total[u] += total[v] - 2 * weight
                pull[u] += pull[v]
                goes_with[v], near[v] = u, {}
                queue.append(u)
    rest = [v for v in range(len(odds)) if side[v] is None and goes_with[v] == v]
    reached = source_side(rest, pull, near) if rest else set()
    for v in rest:
        side[v] = v in reached
    for v in range(len(odds)):
        chain = []
        while goes_with[v] != v:
            chain.append(v)
            v = goes_with[v]
        for x in chain:
            goes_with[x], side[x] = v, side[v]
    return [bool(x) for x in side]


def source_side(nodes: list[int], pull: list[int], near: list[dict[int, int]]) -> set[int]:
    """Nodes that the source still reaches after a maximum flow, by blocking flows over distance levels."""
    source, sink = -1, -2
    left: dict[int, dict[int, int]] = {v: dict(near[v]) for v in nodes}
    left[source], left[sink] = {}, {}
    for v in nodes:
        a, b = (source, v) if pull[v] > 0 else (v, sink)
        left[a][b], left[b][a] = abs(pull[v]), 0
    while True:
        level = {source: 0}
        queue = deque([source])
        while queue:
            v = queue.popleft()
            for u, room in left[v].items():
                if room > 0 and u not in level:
                    level[u] = level[v] + 1
                    queue.append(u)
        if sink not in level:
            return set(level) - {source}
        ahead = {v: [u for u in left[v] if level.get(u) == level[v] + 1] for v in level}
        path = [source]
        while path:
            v = path[-1]
            if v == sink:
                steps = list(zip(path, path[1:]))
                flow = min(left[a][b] for a, b in steps)
                for a, b in steps:
                    left[a][b] -= flow
                    left[b][a] += flow
                del path[next(i for i, (a, b) in enumerate(steps) if not left[a][b]) + 1:]
                continue
            while ahead[v] and not left[v][ahead[v][-1]]:
                ahead[v].pop()
            if ahead[v]:
                path.append(ahead[v][-1])
            else:
                path.pop()
                if path:
                    ahead[path[-1]].pop()


def main_text(html: str | None, weights: tuple[float, ...] = PRIOR) -> str:
    page = PageReader(html or "")
    content = minimum_cut(*page_graph(page, weights))
    return "\n".join(block[0] for block, keep in zip(page.blocks, content) if keep)


def fit_weights(pages: DataFrame, html: str = "html", sample_pages: int = SAMPLE_PAGES) -> tuple[float, ...]:
    """Weights of the block classifier, from blocks below marked elements of a bounded sample of different pages.

    Counted per combination of feature values (a few thousand at most), so the driver's part does not grow with the
    pages' length. The fit is logistic regression by Newton's method around the prior weights.
    """
    keyed = pages.select(F.xxhash64(html).alias("key"), F.col(html).alias("html")).filter("html is not null")
    last = keyed.select("key").distinct().orderBy("key").limit(sample_pages).agg(F.max("key")).first()[0]
    if last is None:
        return PRIOR
    sample = keyed.filter(F.col("key") <= last).groupBy("key").agg(F.min("html").alias("html")).select("html")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for value in batch.column(0):
                found.update((features, mark > 0) for _, features, _, mark in PageReader(value.as_py()).blocks if mark)
        rows = [(*features, kept, n) for (features, kept), n in found.items()]
        names = ["words", "links", "ends", "content", "n"]
        yield pa.RecordBatch.from_pylist([dict(zip(names, map(int, row))) for row in rows], pa.schema([(x, pa.int64()) for x in names]))

    fields = ["words", "links", "ends", "content"]
    counted = sample.mapInArrow(count, ", ".join(f"{x} bigint" for x in [*fields, "n"])).groupBy(*fields).agg(F.sum("n").alias("n"))
    rows = np.array(sorted(tuple(r) for r in counted.collect()), dtype=float).reshape(-1, 5)
    return _newton(rows[:, :3] / [10, 10, 1], rows[:, 3], rows[:, 4])


def _newton(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, ...]:
    """Weighted logistic regression; both classes weigh the same, the prior as much as ``PRIOR_STRENGTH`` blocks."""
    if len(set(y)) < 2:
        return PRIOR
    x = np.column_stack([np.ones(len(x)), x])
    n = np.where(y > 0, n / n[y > 0].sum(), n / n[y <= 0].sum()) * n.sum() / 2
    prior = np.array(PRIOR)
    w = prior.copy()

    def loss(v):
        z = x @ v
        return float(n @ (np.logaddexp(0, z) - y * z) + PRIOR_STRENGTH / 2 * ((v - prior) ** 2).sum())

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        slope = x.T @ (n * (p - y)) + PRIOR_STRENGTH * (w - prior)
        step = np.linalg.solve((x.T * (n * p * (1 - p))) @ x + PRIOR_STRENGTH * np.eye(len(w)), slope)
        size = 1.0
        while loss(w - size * step) > loss(w) and size > 1e-6:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return tuple(round(float(v), 6) for v in w)


def extract_pages(pages: DataFrame, html: str = "html", weights: tuple[float, ...] = PRIOR) -> DataFrame:
    """Adds ``main_text``; pages are independent, so nothing is shuffled."""

    @F.arrow_udf("string")
    def extract(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([main_text(x.as_py(), weights) for x in batch], pa.string())

    return pages.withColumn("main_text", extract(F.col(html)))
