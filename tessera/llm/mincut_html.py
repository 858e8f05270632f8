"""Main-content extraction from HTML by a minimum cut.

A page becomes a row of text blocks. A classifier's log-odds are the capacities
to the terminals (content, boilerplate); neighbouring blocks and blocks close in
the DOM are tied by smoothness edges. The minimum cut, found by max-flow, is the
labelling of least total cost. Blocks whose terminal capacity exceeds all their
edges keep that label in any minimum cut and are settled first (exactly), which
leaves max-flow the ambiguous ones.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, one_text_each, table

#: The classifier is fitted on at most so many pages, chosen by hash of the id; their semantic elements label the blocks.
FIT_PAGES = 600
ADJACENT = 1.0
SIBLING = 0.5
COUSIN = 0.25
#: Log-odds that a semantic container adds to its blocks.
CONTAINER = 2.0
#: A comment or an element without text of its own that isn't closed goes on to the end; the last alternative is a tag.
_TAG = re.compile(r"<!--(?:.*?(-->)|.*)|<(script|style|noscript|template|title|svg|iframe|textarea|select)\b[^>]*>(?:.*?(</\2\s*>)|.*)|<![^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9]*)([^>]*)>", re.S | re.I)
_BLOCK = frozenset("address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
_AGAINST = frozenset("nav footer aside header form menu button dialog".split())
_FOR = frozenset("article main".split())
#: Values of the attributes that may tell what an element is for; each character is looked at once.
_NAMED = re.compile(r"(?:class|id|role)\s*=\s*[\"']?([^\"'>]*)", re.I)
_HINT = re.compile(r"(?:\b|_)(?:(ads?|advert\w*|banner|nav\w*|menu\w*|sidebar|footer|header|cookie\w*|promo\w*|share|social|related|comments?|breadcrumbs?|sponsor\w*|popup|widget|contentinfo|complementary|navigation)|(article|main|content|post|entry|story|body))(?:\b|_)", re.I)
#: For <p>, <li>, ...: opening one closes one that is open.
_SELF_CLOSING = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_LONG_NUMBER = re.compile(r"&#0*[1-9][0-9]{9,};?")
_WORD_END = re.compile(r"[.!?:;,]")
FEATURES = ("bias", "log words", "link share", "marks per word", "p", "heading", "li", "hint")
#: Used where the sample has no semantic elements to learn from.
DEFAULT = np.array([-2.0, 0.9, -3.0, 2.0, 1.0, 1.5, -0.5, 2.0])


def decoded(text: str) -> str:
    """``html.unescape``, also of numbers that are too long for Python to read (as other numbers beyond Unicode, they become U+FFFD)."""
    try:
        return entities.unescape(text)
    except ValueError:
        return entities.unescape(_LONG_NUMBER.sub("&#x110000;", text))


def _named(attributes: str) -> int:
    """1 for content, -1 for boilerplate, 0 for neither, by the first hint in a class, id or role."""
    for value in _NAMED.finditer(attributes):
        if h := _HINT.search(value[1]):
            return -1 if h[1] else 1
    return 0


def blocks(page: str) -> list[tuple[str, str, int, int, int, int, int]]:
    """(text, element, parent, linked characters, container: 1 content / -1 boilerplate / 0, hint alike, grandparent) of each block of text, in time linear in the page."""
    out = []
    stack: list[tuple[str, int, int, int]] = [("", 0, 0, 0)]  # element, number, container, hint
    number = 0
    text: list[str] = []
    linked = links = 0
    here = stack[0]
    parent = grandparent = 0

    def flush():
        nonlocal linked
        if text:
            joined = "".join(text)
            if "&" in joined:
                joined = decoded(joined)
            joined = " ".join(joined.split())
            if joined:
                out.append((joined, here[0], parent, linked, here[2], here[3], grandparent))
            text.clear()
        linked = 0

    at = 0
    opened: dict[str, int] = {}  # how often each element is on the stack
    # nothing after the last ">" can be a tag; a comment or script that is open there ends the text
    end = page.rfind(">") + 1
    tail = page.find("<!--", end)
    for m in _TAG.finditer(page, 0, end):
        if m.start() > at:
            piece = page[at : m.start()]
            text.append(piece)
            if links:
                linked += len(piece)
        at = m.end()
        name = m[5]
        if name is None:
            if at == end and not m[1] and not m[3] and (m[2] or page.startswith("<!--", m.start())):
                tail = end
            continue
        name = name.lower()
        if name not in _BLOCK:
            if name == "a":
                links = 0 if m[4] else 1
            elif name == "br":
                text.append(" ")
            continue
        if text:
            flush()
        linked = links = 0
        if m[4]:
            while opened.get(name):  # each pop undoes one push, so closing tags take no longer than opening ones
                gone = stack.pop()[0]
                opened[gone] -= 1
                if gone == name:
                    break
        elif name != "hr":
            closes = _SELF_CLOSING.get(name)
            if closes and stack[-1][0] in closes:
                opened[stack.pop()[0]] -= 1
            number += 1
            container, hint = stack[-1][2], stack[-1][3]
            if name in _AGAINST:
                container = -1
            elif name in _FOR:
                container = 1
            if m[6]:
                hint = _named(m[6]) or hint
            stack.append((name, number, container, hint))
            opened[name] = opened.get(name, 0) + 1
        here = stack[-1]
        parent = stack[-2][1] if len(stack) > 1 else 0
        grandparent = stack[-3][1] if len(stack) > 2 else 0
    last = len(page) if tail < 0 else tail
    if at < last:
        text.append(page[at:last])
        if links:
            linked += last - at
    flush()
    return out


def features(bs: list) -> np.ndarray:
    x = np.zeros((len(bs), len(FEATURES)))
    for k, (text, name, _, linked, _, hint, _) in enumerate(bs):
        words = text.count(" ") + 1
        x[k] = (1, math.log1p(words), min(linked / len(text), 1), min(len(_WORD_END.findall(text)) / words, 1), name == "p", name[0:1] == "h" and name[1:2].isdigit(), name == "li", hint)
    return x


def fit(pages: DataFrame, limit: int = FIT_PAGES) -> np.ndarray:
    """Of at most ``limit`` pages with different ids, the weights of a logistic regression of "inside article or main" against "inside nav, footer, aside..." on the block features."""
    rows = pages.where("html IS NOT NULL").select(F.col("page_id").cast("long").alias("page_id"), F.xxhash64("page_id").alias("__h"))
    chosen = [r.page_id for r in rows.where("page_id IS NOT NULL").distinct().orderBy("__h", "page_id").limit(limit).collect()]
    if not chosen:
        return DEFAULT
    sample = one_text_each(pages.select(F.col("page_id").alias("doc_id"), F.col("html").alias("text")), chosen)["text"].to_pylist()
    labelled = [b for page in sample for b in blocks(page) if b[4]]
    y = np.array([b[4] > 0 for b in labelled], float)
    if not len(y) or y.min() == y.max():
        return DEFAULT
    x = features(labelled)
    w = np.zeros(x.shape[1])
    balance = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    for _ in range(30):  # Newton steps with a ridge, so separable blocks keep finite odds
        p = 1 / (1 + np.exp(-x @ w))
        grad = x.T @ (balance * (p - y)) + 1.0 * w
        hess = (x * (balance * p * (1 - p))[:, None]).T @ x + 1.0 * np.eye(len(w))
        w -= np.linalg.solve(hess, grad)
    return w


def min_cut(cost: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes are on the source side of a minimum cut.

    ``cost`` > 0 is the capacity from the source, < 0 that to the sink. Of several
    minimum cuts it is the one with the smallest source side.
    """
    n = len(cost)
    near: list[list[tuple[int, float]]] = [[] for _ in range(n)]
    tie = [0.0] * n
    for a, b, w in edges:
        near[a].append((b, w))
        near[b].append((a, w))
        tie[a] += w
        tie[b] += w
    side: list[bool | None] = [None] * n
    cost = list(cost)
    todo = deque(range(n))
    while todo:
        k = todo.popleft()
        if side[k] is None and abs(cost[k]) > tie[k] + 1e-12:
            side[k] = cost[k] > 0
            for j, w in near[k]:
                if side[j] is None:
                    cost[j] += w if side[k] else -w
                    tie[j] -= w
                    todo.append(j)
    left = [k for k in range(n) if side[k] is None]
    if not left:
        return side
    # max-flow over the rest: shortest augmenting paths
    at = {k: i for i, k in enumerate(left)}
    m = len(left)
    s, t = m, m + 1
    to: list[int] = []
    cap: list[float] = []
    out: list[list[int]] = [[] for _ in range(m + 2)]

    def edge(a, b, c, back):
        out[a].append(len(to))
        to.append(b)
        cap.append(c)
        out[b].append(len(to))
        to.append(a)
        cap.append(back)

    for k in left:
        if cost[k] > 0:
            edge(s, at[k], cost[k], 0.0)
        elif cost[k] < 0:
            edge(at[k], t, -cost[k], 0.0)
        for j, w in near[k]:
            if j > k and side[j] is None:
                edge(at[k], at[j], w, w)
    while True:
        level = [-1] * (m + 2)
        level[s] = 0
        queue = deque([s])
        while queue:
            u = queue.popleft()
            for e in out[u]:
                if cap[e] > 1e-12 and level[to[e]] < 0:
                    level[to[e]] = level[u] + 1
                    queue.append(to[e])
        if level[t] < 0:
            break
        nxt = [0] * (m + 2)
        path: list[int] = []
        u = s
        while True:
            if u == t:
                f = min(cap[e] for e in path)
                for e in path:
                    cap[e] -= f
                    cap[e ^ 1] += f
                path, u = [], s
                continue
            while nxt[u] < len(out[u]):
                e = out[u][nxt[u]]
                if cap[e] > 1e-12 and level[to[e]] == level[u] + 1:
                    path.append(e)
                    u = to[e]
                    break
                nxt[u] += 1
            else:
                if u == s:
                    break
                u = to[path.pop() ^ 1]
                nxt[u] += 1
    for k in left:
        side[k] = level[at[k]] >= 0
    return side


def graph(bs: list) -> list[tuple[int, int, float]]:
    """Smoothness edges: neighbouring blocks, and blocks that are close in the DOM (consecutive ones of one parent, or of one grandparent, element)."""
    edges = []
    by_parent: dict[int, int] = {}
    by_grandparent: dict[int, int] = {}
    for k, b in enumerate(bs):
        tie = {k - 1: ADJACENT} if k else {}
        for last, element, weight in ((by_parent, b[2], SIBLING), (by_grandparent, b[6], COUSIN)):
            if (j := last.get(element)) is not None:
                tie[j] = tie.get(j, 0.0) + weight
            last[element] = k
        edges += [(j, k, w) for j, w in tie.items()]
    return edges


def main_text(page: str, weights: np.ndarray) -> tuple[str, int, int]:
    """(content blocks joined by newlines, blocks, content blocks)."""
    bs = blocks(page)
    if not bs:
        return "", 0, 0
    odds = np.clip(features(bs) @ weights, -6, 6) + CONTAINER * np.array([b[4] for b in bs])
    keep = min_cut(odds.tolist(), graph(bs))
    kept = [b[0] for b, k in zip(bs, keep, strict=True) if k]
    return "\n".join(kept), len(bs), len(kept)


def extract(pages: DataFrame, weights: np.ndarray) -> DataFrame:
    """(page_id, text, n_blocks, n_content) of every row.

    A null page has null text and 0 blocks; an empty one, or one without text,
    empty text. Ties of the cut go to boilerplate. Repeated rows are extracted one
    by one; null ids are carried and other columns not read.
    """

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        found = [(None, 0, 0) if x is None else main_text(x, weights) for x in b.column("html").to_pylist()]
        return pa.record_batch([b.column("page_id"), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.int32()), pa.array([x[2] for x in found], pa.int32())], ["page_id", "text", "n_blocks", "n_content"])

    narrow = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("html").cast("string").alias("html"))
    return map_batches(narrow, each, "page_id long, text string, n_blocks int, n_content int")


def op8_html_mincut(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract(pages, fit(pages))
