"""Main-text extraction from HTML: boosted trees over DOM nodes, hierarchical decoding.

Every element of a page becomes a row of features: tag, tokens of class, id and role, depth, text and
link density of its subtree, place among its siblings, and the same of its parent. Gradient-boosted
trees give each node the log odds of being boilerplate; they are trained here, on a bounded sample
of pages drawn across their templates, labelled by their own markup, or by text and links where that
says nothing. Decoding walks each tree from the root down and
picks the labelling of most total evidence in which a boilerplate node has only boilerplate below
it, so a child can never contradict its ancestor.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TRAIN_PAGES, TRAIN_NODES = 400, 1000     # pages, and elements of each, that the trees are fitted on, fitting only
TEMPLATE_SLOTS = 4096                    # pages of a template that stand for it when the sample is drawn
MAIN_CHARS = 80                          # text outside links from which a page without main markup says where its main text is
TREES, DEPTH, RATE = 40, 4, 0.3
SCORED_NODES = 1 << 13                   # elements of consecutive pages that go through the trees at once
SEED = 2

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe object svg math textarea select title".split())
BLOCK = frozenset(("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
                   "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table "
                   "tbody td tfoot th thead tr ul").split())
#: Elements that end an open element of the same group when one of the group starts.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "option": ("option",)}
CLOSE_LIMIT = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table", "tbody", "thead", "tfoot"),
               "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
ENDS_P = BLOCK - {"body", "html", "li", "dd", "dt", "td", "th", "tr", "tbody", "thead", "tfoot"}
TAGS = ("a article aside b blockquote body button div em figure footer form h1 h2 h3 head header html i iframe img input "
        "li main nav ol p pre script section span strong style table td tr ul noscript title select textarea svg").split()
#: Words in class, id and role that speak for boilerplate or for main text.
AWAY = ("ad ads advert advertisement banner sponsor promo nav navbar menu breadcrumb header masthead footer sidebar aside "
        "widget related share social comment comments reply discussion disqus notice cookie consent popup modal newsletter subscribe "
        "form login signup search pagination pager tags copyright complementary navigation contentinfo alert hidden").split()
TOWARDS = "article content main post entry story body text".split()
AWAY_TAGS = frozenset("nav header footer aside form script style noscript head title template iframe button select textarea svg object menu dialog".split())

#: Elements that hold the parts of a page; the others hold one part.
HOLDERS = BLOCK - frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote address hr ul ol li dl dt dd figure figcaption".split())

_TAG = re.compile(r"<(?:!--.*?(?:-->|$)|(!|\?)[^>]*>?|(/?)([a-zA-Z][^\s/>]*))", re.S)
_EDGE = re.compile("[>\"']")
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_TOKEN = re.compile(r"[a-z]+|[0-9]+", re.I)


def _tag_end(html: str, at: int, known: dict[int, int]) -> int:
    """Where the tag whose attributes begin at ``at`` is closed, outside quotes; -1 if it never is. ``known`` holds the answers of
    a page by the quote they were found from, and under -1 and -2 the last stretch without quote or end, so a page is gone through once."""
    path, end = [], -1
    while True:
        if not known.get(-1, len(html) + 1) <= at <= known.get(-2, -1):
            hit = _EDGE.search(html, at)
            known[-1], known[-2] = at, hit.start() if hit else len(html)
        at = known[-2]
        if at >= len(html):
            break
        if at in known or html[at] == ">":
            end = known.get(at, at)
            break
        path.append(at)
        at = html.find(html[at], at + 1) + 1
        if not at:
            break
    known.update(dict.fromkeys(path, end))
    return end


class Page:
    """Elements of a page in document order: tag, parent, attribute tokens, and text pieces.

    ``pieces`` are (element, text) in page order; text has its references decoded.
    """

    __slots__ = ("tags", "parents", "tokens", "pieces")

    def __init__(self, html: str):
        self.tags, self.parents, self.tokens, self.pieces = ["#root"], [-1], [frozenset()], []
        stack, at, size, known = [0], 0, len(html), {}
        search = 0
        while at < size:
            hit = _TAG.search(html, search)
            if hit is None:
                self._text(stack[-1], html[at:])
                break
            closing, name = hit.group(2), hit.group(3)
            end = hit.end()
            if name is not None:
                closed = _tag_end(html, end, known)
                if closed < 0:      # no tag: text up to the next one
                    search = hit.start() + 1
                    continue
                attributes, end = html[end:closed], closed + 1
            if hit.start() > at:
                self._text(stack[-1], html[at:hit.start()])
            at = search = end
            if name is None:
                continue
            name = name.lower()
            if closing:
                self._close(stack, name)
                continue
            self._implied(stack, name)
            self.tags.append(name)
            self.parents.append(stack[-1])
            self.tokens.append(self._tokens(attributes) if attributes.strip(" /\n\t") else frozenset())
            if name in VOID or attributes.endswith("/") and name not in BLOCK and name not in RAW:
                if name == "br" or name == "hr":
                    self.pieces.append((len(self.tags) - 1, " "))
                continue
            if name in RAW and name not in ("noscript", "select", "svg", "math", "object", "template"):
                end = re.compile(rf"</{name}\b[^>]*>", re.I).search(html, at)
                at = search = end.end() if end else size
                continue
            stack.append(len(self.tags) - 1)

    def _text(self, element: int, raw: str) -> None:
        self.pieces.append((element, unescape(raw) if "&" in raw else raw))

    def _implied(self, stack: list[int], name: str) -> None:
        if name in ENDS_P:
            for k in range(len(stack) - 1, 0, -1):
                tag = self.tags[stack[k]]
                if tag == "p":
                    del stack[k:]
                    break
                if tag in BLOCK:
                    break
        if name in CLOSES:
            for k in range(len(stack) - 1, 0, -1):
                tag = self.tags[stack[k]]
                if tag in CLOSES[name]:
                    del stack[k:]
                    break
                if tag in CLOSE_LIMIT[name]:
                    break

    def _close(self, stack: list[int], name: str) -> None:
        for k in range(len(stack) - 1, 0, -1):
            tag = self.tags[stack[k]]
            if tag == name:
                del stack[k:]
                return
            if name not in BLOCK and tag in BLOCK:
                return     # a stray end of an inline element does not end blocks

    @staticmethod
    def _tokens(attributes: str) -> frozenset[str]:
        found = set()
        for hit in _ATTRIBUTE.finditer(attributes):
            value = hit.group(2) or hit.group(3) or hit.group(4) or ("hidden" if hit.group(1).lower() == "hidden" else "")
            found.update(t.lower() for t in _TOKEN.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", value)))
        return frozenset(found)


_TAG_AT = {t: k for k, t in enumerate(TAGS)}
_AWAY_AT = {t: k for k, t in enumerate(AWAY)}
_TOWARDS_AT = {t: k for k, t in enumerate(TOWARDS)}
_OWN = len(TAGS) + len(AWAY) + len(TOWARDS)
_NUMBERS = 10
WIDTH = 2 * _OWN + _NUMBERS


def node_features(page: Page) -> np.ndarray:
    """One row per element (the root included)."""
    n = len(page.tags)
    parents = np.array(page.parents)
    own_text, own_link, blocks = np.zeros(n), np.zeros(n), np.zeros(n)
    for element, text in page.pieces:
        own_text[element] += len(text)
    x = np.zeros((n, WIDTH), np.float32)
    inside_a = np.zeros(n, bool)
    depth, children, rank = np.zeros(n), np.zeros(n), np.zeros(n)
    for k in range(1, n):
        up = page.parents[k]
        depth[k] = depth[up] + 1
        rank[k] = children[up]
        children[up] += 1
        inside_a[k] = inside_a[up] or page.tags[k] == "a"
        if page.tags[k] in _TAG_AT:
            x[k, _TAG_AT[page.tags[k]]] = 1
        for token in page.tokens[k]:
            if token in _AWAY_AT:
                x[k, len(TAGS) + _AWAY_AT[token]] = 1
            if token in _TOWARDS_AT:
                x[k, len(TAGS) + len(AWAY) + _TOWARDS_AT[token]] = 1
    own_link[inside_a] = own_text[inside_a]
    text, link, count = own_text.copy(), own_link, np.ones(n)
    for k in range(n - 1, 0, -1):      # children come after their parent
        up = page.parents[k]
        text[up] += text[k]
        link[up] += link[k]
        count[up] += count[k]
    siblings = children[parents]
    x[1:, _OWN:2 * _OWN] = x[parents[1:], :_OWN]
    x[:, 2 * _OWN:] = np.stack([
        depth, np.log1p(text), text / count, link / np.maximum(text, 1), np.log1p(count), np.log1p(children),
        np.log1p(siblings), rank / np.maximum(siblings, 1), text / max(text[0], 1), np.log1p(own_text)], axis=1)
    return x


def markup_label(page: Page) -> np.ndarray:
    """What the page itself says of every element: 1 boilerplate, 0 main text, -1 nothing.

    An element is boilerplate by its tag or by a token of its class, id or role (of html and body the
    tokens speak for the whole page and are left aside), or by an ancestor that is. Main text is what
    is no boilerplate and lies in an article or main element. Where these hold no text outside links, it
    lies in elements with a token of main text, if these hold most text outside links, and else in
    the smallest part of the page that does; there, blocks of links are not labelled inside the
    main text and are boilerplate outside.
    """
    n = len(page.tags)
    out = np.full(n, -1)
    away, towards, link = set(AWAY), set(TOWARDS), np.zeros(n, bool)
    marked, named = np.zeros(n, bool), np.zeros(n, bool)
    for k in range(1, n):
        up, tag = page.parents[k], page.tags[k]
        tokens = page.tokens[k] if tag not in ("html", "body") else frozenset()
        link[k] = link[up] or tag == "a"
        if out[up] == 1 or tag in AWAY_TAGS or tokens & away:
            out[k] = 1
            continue
        marked[k] = marked[up] or tag in ("article", "main")
        named[k] = named[up] or bool(tokens & towards)
    plain, linked = np.zeros(n), np.zeros(n)
    for element, text in page.pieces:
        if out[element] != 1:
            (linked if link[element] else plain)[element] += len("".join(text.split()))
    by_mark, by_name, whole = plain[marked].sum(), plain[named].sum(), plain.sum()
    if by_mark or whole < MAIN_CHARS:
        out[marked & (out != 1)] = 0
        return out
    for k in range(n - 1, 0, -1):
        plain[page.parents[k]] += plain[k]
        linked[page.parents[k]] += linked[k]
    if 2 * by_name > whole:
        main = named
    else:
        at = 0
        for k in range(1, n):       # in page order, so a part comes after what holds it
            if page.parents[k] == at and page.tags[k] in HOLDERS and out[k] != 1 and 2 * plain[k] > whole:
                at = k
        main = np.zeros(n, bool)
        main[at] = True
        for k in range(at + 1, n):
            main[k] = main[page.parents[k]]
    above = main.copy()
    for k in range(n - 1, 0, -1):
        above[page.parents[k]] |= above[k]
    links = np.zeros(n, bool)
    for k in range(1, n):
        links[k] = links[page.parents[k]] or page.tags[k] in BLOCK and linked[k] > plain[k] and (main[k] or not above[k])
        if out[k] != 1 and (main[k] or links[k]):
            out[k] = (-1 if links[k] else 0) if main[k] else 1
    return out


class Trees:
    """Gradient-boosted regression trees for the log odds of a binary label, on binned features."""

    def __init__(self, trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]], base: float):
        self.trees, self.base = trees, base

    def odds(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                split = feature[node]
                node = np.where(split < 0, node, 2 * node + 1 + (x[rows, np.maximum(split, 0)] > cut[node]))
            total += value[node]
        return total


def fit_trees(x: np.ndarray, y: np.ndarray) -> Trees:
    """Newton boosting of complete trees of ``DEPTH`` levels, at most 32 cuts per feature. No trees if all
    labels are the same, as these do not tell the classes apart."""
    share = min(max(y.mean(), 1e-3), 1 - 1e-3) if len(y) else 0.5
    base = float(np.log(share / (1 - share)))
    if not len(y) or y.min() == y.max():
        return Trees([], base)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, 33)[:-1])) for f in range(x.shape[1])]
    cuts = [c[c < x[:, f].max()] for f, c in enumerate(cuts)]
    cuts = [np.array([0.0]) if not len(c) and x[:, f].max() > 0 and x[:, f].min() <= 0 else c for f, c in enumerate(cuts)]
    used = [f for f in range(x.shape[1]) if len(cuts[f])]
    bins = {f: np.searchsorted(cuts[f], x[:, f], "left") for f in used}    # bin b: x > cuts[b-1]
    total, trees = np.full(len(y), base), []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-total))
        g, h = y - p, p * (1 - p)
        feature, cut, value = np.full(2 ** (DEPTH + 1), -1), np.zeros(2 ** (DEPTH + 1)), np.zeros(2 ** (DEPTH + 1))
        node = np.zeros(len(y), np.int64)
        for _level in range(DEPTH):
            for k in np.unique(node):
                at = np.flatnonzero(node == k)
                gk, hk = g[at], h[at]
                best, whole = 1e-6, gk.sum() ** 2 / (hk.sum() + 1)
                for f in used:
                    gs = np.bincount(bins[f][at], gk, len(cuts[f]) + 1).cumsum()
                    hs = np.bincount(bins[f][at], hk, len(cuts[f]) + 1).cumsum()
                    gain = gs[:-1] ** 2 / (hs[:-1] + 1) + (gs[-1] - gs[:-1]) ** 2 / (hs[-1] - hs[:-1] + 1) - whole
                    b = int(gain.argmax())
                    if gain[b] > best:
                        best, feature[k], cut[k] = gain[b], f, cuts[f][b]
                if feature[k] >= 0:
                    node[at] = 2 * k + 1 + (x[at, feature[k]] > cut[k])
        for k in np.unique(node):
            at = node == k
            value[k] = RATE * g[at].sum() / (h[at].sum() + 1)
        total += value[node]
        trees.append((feature, cut, value))
    return Trees(trees, base)


def decode(page: Page, odds: np.ndarray) -> np.ndarray:
    """True where an element is main text: the labelling of most evidence without contradictions.

    ``odds`` are for boilerplate. best[k] is the most evidence of the subtree of k if k is main text; a
    boilerplate k takes its whole subtree along. Elements under a boilerplate one are never main.
    """
    n = len(page.tags)
    subtree = odds.copy()
    for k in range(n - 1, 0, -1):
        subtree[page.parents[k]] += subtree[k]
    best = -odds
    for k in range(n - 1, 0, -1):
        best[page.parents[k]] += max(best[k], subtree[k])
    main = np.zeros(n, bool)
    main[0] = True
    for k in range(1, n):
        main[k] = main[page.parents[k]] and best[k] >= subtree[k]
    return main


def main_text(page: Page, main: np.ndarray) -> str:
    """Text of the main elements: blocks in page order, white space collapsed, joined by line ends."""
    lines, current, owner = [], [], None
    block = [0] * len(page.tags)
    for k in range(1, len(page.tags)):
        block[k] = k if page.tags[k] in BLOCK else block[page.parents[k]]
    for element, text in page.pieces:
        if not main[element]:
            if block[element] != owner:       # boilerplate between blocks parts them, inside a block it does not
                lines.append("".join(current))
                current, owner = [], None
            continue
        if block[element] != owner:
            lines.append("".join(current))
            current, owner = [], block[element]
        current.append(text)
    lines.append("".join(current))
    joined = (" ".join(line.split()) for line in lines)
    return "\n".join(line for line in joined if line)


def sampled(pages: DataFrame) -> DataFrame:
    """At most TRAIN_PAGES distinct pages (html), whole: one of each template before a second of any, of
    the commoner templates first. Pages of a template have the same tokens of class, id and role, digits
    aside, or the same tags if they have no tokens."""
    html = F.col("html")
    known = pages.select(F.col("html").cast("string").alias("html")).where("html is not null")
    marks = F.regexp_extract_all(html, F.lit(r"(?i)\b(?:class|id|role)\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>\"']+)"), F.lit(0))
    tags = F.regexp_extract_all(html, F.lit(r"<[a-zA-Z][a-zA-Z0-9]*"), F.lit(0))
    marks = F.transform(F.array_distinct(marks), lambda m: F.regexp_replace(F.lower(m), r"[0-9]+|\s+", ""))
    template = F.xxhash64(F.array_sort(F.array_distinct(F.when(F.size(marks) > 0, marks).otherwise(F.transform(F.array_distinct(tags), F.lower)))))
    key = F.xxhash64(F.lit(SEED), html)
    slots = known.select(template.alias("template"), key.alias("key")).groupBy("template", F.pmod("key", F.lit(TEMPLATE_SLOTS)).alias("slot"))
    slots = slots.agg(F.min("key").alias("key"), F.count("*").alias("n"))
    of = Window.partitionBy("template")       # at most TEMPLATE_SLOTS rows each
    ranked = slots.select("key", F.row_number().over(of.orderBy("key")).alias("rank"), F.sum("n").over(of).alias("n"))
    chosen = [r["key"] for r in ranked.orderBy("rank", F.desc("n"), "key").limit(TRAIN_PAGES).collect()]
    return known.where(key.isin(chosen)).groupBy(key.alias("key")).agg(F.min("html").alias("html")).select("html")


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Labels and packed features of at most TRAIN_NODES elements of every page, drawn over the whole page,
    half of them of either label where there are so many."""
    for batch in batches:
        for cell in batch.column(0):
            page = Page(cell.as_py())
            label = markup_label(page)
            drawn = []
            for side in sorted((np.flatnonzero(label == v) for v in (0, 1)), key=len):
                room = (TRAIN_NODES - sum(map(len, drawn))) // (2 - len(drawn))
                drawn.append(side if len(side) <= room else np.sort(np.random.default_rng(SEED).choice(side, room, False)))
            at = np.concatenate(drawn)
            x = node_features(page)[at]
            yield pa.RecordBatch.from_arrays([pa.array([label[at].astype(np.int8).tobytes()], pa.binary()),
                                              pa.array([zlib.compress(x.tobytes(), 1)], pa.binary())], names=["y", "x"])


def fit(pages: DataFrame) -> Trees:
    """Trees fitted on the pages of ``sampled``. Extraction itself always takes all elements of all pages."""
    x, y = [], []
    rows = sorted((r["y"], r["x"]) for r in sampled(pages).mapInArrow(_labelled, "y binary, x binary").collect())
    for labels, packed in rows:
        y.append(np.frombuffer(labels, np.int8))
        x.append(np.frombuffer(zlib.decompress(packed), np.float32).reshape(-1, WIDTH))
    if not x:
        return Trees([], -1.0)
    return fit_trees(np.concatenate(x), np.concatenate(y).astype(float))


def extract(html: str | None, trees: Trees) -> str:
    """Main text of one page; without trees, all that its own markup does not call boilerplate."""
    return next(_extracted([html], trees))


def _extracted(htmls: Iterable[str | None], trees: Trees) -> Iterator[str]:
    """Main text of each page, in order. Elements of consecutive pages are scored together, as most pages are small."""
    held, rows, nodes = [], [], 0

    def scored() -> Iterator[str]:
        odds = trees.odds(np.concatenate(rows)) if rows else np.zeros(0)
        first = 0
        for page in held:
            last = first + (len(page.tags) if page else 0)
            yield main_text(page, decode(page, odds[first:last])) if page else ""
            first = last

    for html in htmls:
        page = Page(html) if html else None
        held.append(page)
        if not page:
            continue
        if not trees.trees:
            held.pop()
            yield from scored()
            held.clear()
            yield main_text(page, decode(page, np.where(markup_label(page) == 1, 1.0, -1.0)))
            continue
        rows.append(node_features(page))
        nodes += len(page.tags)
        if nodes >= SCORED_NODES:
            yield from scored()
            held, rows, nodes = [], [], 0
    yield from scored()


def main_texts(pages: DataFrame, trees: Trees | None = None) -> DataFrame:
    """Main text of every page.

    ``pages`` needs page_id, url, html; other columns are ignored. Null and empty pages have an
    empty text, as have pages without any main element; text outside all tags counts as a block of
    the page itself. Rows that repeat are each extracted.
    Returns page_id, url, text, n_chars.
    """
    trees = fit(pages) if trees is None else trees
    shared = pages.sparkSession.sparkContext.broadcast((trees.trees, trees.base))   # TREES small arrays

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Trees(*shared.value)
        for batch in batches:
            texts = list(_extracted((cell.as_py() for cell in batch.column(2)), model))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    base = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    return base.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
