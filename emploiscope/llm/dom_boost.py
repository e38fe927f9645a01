"""Main text of web pages: boosted trees over DOM nodes, decoded so that no choice contradicts its ancestors.

A page becomes a tree of block elements; inline markup only adds text to the block around it. Every
node gets features (text density of its subtree, attribute words, depth, siblings, ancestors). A
gradient-boosted forest gives the log odds that a node's own text belongs to the article. Decoding
picks the most likely labelling in which nothing inside a rejected node is kept.

The forest is fitted on the nodes of a bounded sample of pages. Their labels come from the pages'
own semantics: what stands in an article or main element is text, what stands in navigation and the
like is not. Each labelled node is shown to the fit in several views, so that the forest learns to do
with whatever a page gives away (see ``views``).
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emploiscope.llm.text import gives_back
from emploiscope.llm.workspace import Workspace, bounded_batches

SAMPLE_PAGES = 400
SAMPLE_NODES = 20_000
TREES = 60
DEPTH = 4
BINS = 32
RATE = 0.3
BATCH_PAGES = 64
# An element around the article or first heading with more than this share of the page's text frames the page.
WHOLE_PAGE = 0.6

# HTML's element categories, and the words that sites use in attributes.
_BLOCK = frozenset(
    "html body div article section main nav aside header footer p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption form fieldset blockquote pre figure figcaption address details summary dialog menu hr center".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style title textarea noscript template iframe select button option head".split())
_REJECTED_TAGS = frozenset("nav aside footer form menu dialog fieldset".split())
_TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd td".split())
_ARTICLE_TAGS = frozenset(("article", "main"))
_CLOSES_P = _BLOCK - {"html", "body"}
_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_SCOPE = frozenset("html body div article section main nav aside header footer ul ol dl table td th form blockquote figure details dialog".split())
_REJECTED_WORDS = frozenset(
    """ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs sidebar aside
    footer header masthead cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup login form search comment comments
    reply replies respond disqus discussion share sharing social related recommended recommendations trending popular widget widgets tags pager pagination toolbar
    copyright legal disclaimer alert skip hidden contentinfo complementary""".split()
)
_TEXT_WORDS = frozenset("article articlebody content contents post entry story body main text prose".split())

# A tag runs to the next > outside quotes, and not past a <, so that tags that never close take linear time.
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/<>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?][^<>]*>", re.S)
_ATTRIBUTE = re.compile(r"(?:class|id|role|itemprop|aria-label|data-component)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)

FEATURES = [
    "rejected_tag",
    "text_tag",
    "rejected_words",
    "text_words",
    "under_rejected_tag",
    "under_rejected_words",
    "under_article",
    "under_text_words",
    "depth",
    "own_chars",
    "subtree_chars",
    "chars_per_node",
    "link_share",
    "links",
    "marks",
    "sibling_place",
    "siblings",
    "same_tag_siblings",
    "sibling_chars",
    "page_place",
    "page_share",
]
_TAGS = [FEATURES.index(x) for x in ("rejected_tag", "text_tag", "under_rejected_tag", "under_article")]
_WORDS = [FEATURES.index(x) for x in ("rejected_words", "text_words", "under_rejected_words", "under_text_words")]


@dataclass
class Page:
    """Block nodes in document order (a parent comes before its children) and runs of text ``(node, text)``."""

    tags: list[str]
    words: list[tuple[int, int]]
    parents: list[int]
    runs: list[tuple[int, str]]
    link_chars: list[int]
    links: list[int]


def parse(source: str) -> Page:
    """A forgiving parse: unclosed and unknown elements, stray end tags and cut-off pages are all right."""
    page = Page(["#page"], [(0, 0)], [-1], [], [0], [0])
    stack: list[tuple[str, int]] = [("#page", 0)]
    parts: list[str] = []
    in_link = position = 0

    def flush() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if text:
                page.runs.append((stack[-1][1], text))

    def add(text: str) -> None:
        parts.append(text)
        if in_link:
            page.link_chars[stack[-1][1]] += len(text.strip())

    lowered = None
    while True:
        m = _TOKEN.search(source, position)
        if m is None:
            add(source[position:])
            break
        if m.start() > position:
            add(source[position : m.start()])
        position = m.end()
        name = m[2].lower() if m[2] else ""
        if not name:
            continue
        if m[1]:
            if name == "a":
                in_link = 0
            elif name == "p" or name in _BLOCK:
                depth = next((k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == name), 0)
                if depth and (name in _SCOPE or not any(stack[k][0] in _SCOPE for k in range(depth + 1, len(stack)))):
                    flush()
                    del stack[depth:]
                    in_link = 0
            continue
        if name in _RAW and not m[3].rstrip().endswith("/"):
            # Its content is no text of the page: go on behind its end tag.
            lowered = source.lower() if lowered is None else lowered
            end = lowered.find(f"</{name}", position)
            if name == "head" and end < 0:
                end = lowered.find("<body", position)
                position = end if end >= 0 else len(source)
            else:
                position = len(source) if end < 0 else (source.find(">", end) + 1 or len(source))
        elif name == "a":
            in_link = 1
            page.links[stack[-1][1]] += 1
        elif name == "br" or name in _VOID and name != "hr":
            parts.append(" ")
        elif name in _BLOCK:
            flush()
            closed = ({"p"} if name in _CLOSES_P else set()) | _SAME.get(name, set())
            k = len(stack) - 1
            while k > 0 and stack[k][0] not in closed and stack[k][0] not in _SCOPE:
                k -= 1
            if k > 0 and stack[k][0] in closed:
                del stack[k:]
                in_link = 0
            if name == "hr":
                continue
            page.parents.append(stack[-1][1])
            page.tags.append(name)
            page.words.append(_attribute_words(m[3]))
            page.link_chars.append(0)
            page.links.append(0)
            stack.append((name, len(page.tags) - 1))
    flush()
    return page


def _attribute_words(attributes: str) -> tuple[int, int]:
    if not attributes or "=" not in attributes and "hidden" not in attributes:
        return 0, 0
    words = [w for m in _ATTRIBUTE.finditer(attributes) for w in _WORD.findall(_CAMEL.sub(" ", m[1] or m[2] or m[3] or "").lower())]
    rejected = sum(w in _REJECTED_WORDS for w in words) + bool(_HIDDEN.search(attributes))
    return rejected, 0 if rejected else sum(w in _TEXT_WORDS for w in words)


def features(page: Page) -> np.ndarray:
    n = len(page.tags)
    parents = np.array(page.parents)
    own, marks = np.zeros(n), np.zeros(n)
    for node, text in page.runs:
        own[node] += len(text)
        marks[node] += sum(text.count(c) for c in ".,;:!?")
    subtree, size, link_chars, links = own.copy(), np.ones(n), np.array(page.link_chars, dtype=float), np.array(page.links, dtype=float)
    for i in range(n - 1, 0, -1):
        p = parents[i]
        subtree[p] += subtree[i]
        size[p] += size[i]
        link_chars[p] += link_chars[i]
        links[p] += links[i]
    frames = np.zeros(n, dtype=bool)
    for i in range(n - 1, 0, -1):
        frames[parents[i]] |= frames[i] or page.tags[i] in _ARTICLE_TAGS or page.tags[i] == "h1"
    total = max(1.0, subtree[0])
    x = np.zeros((n, len(FEATURES)))
    depth = np.zeros(n)
    under = np.zeros((n, 4))
    children, place, same = np.zeros(n), np.zeros(n), np.zeros(n)
    tag_counts: dict[tuple[int, str], int] = {}
    for i in range(1, n):
        p, tag, (rejected, wanted) = parents[i], page.tags[i], page.words[i]
        depth[i] = depth[p] + 1
        article = under[p, 2] or tag in _ARTICLE_TAGS
        bad = tag in _REJECTED_TAGS or tag == "header" and not article
        # What frames the whole page rejects nothing, whatever its classes, and be it a form.
        if tag in ("html", "body") or frames[i] and subtree[i] > WHOLE_PAGE * total:
            bad, rejected = False, 0
        x[i, 0], x[i, 1], x[i, 2], x[i, 3] = bad, tag in _TEXT_TAGS, min(rejected, 2), min(wanted, 2)
        under[i] = under[p, 0] or bad, under[p, 1] or rejected > 0, article, under[p, 3] or wanted > 0
        place[i] = children[p]
        children[p] += 1
        key = (p, tag)
        tag_counts[key] = tag_counts.get(key, 0) + 1
    for i in range(1, n):
        same[i] = tag_counts[(parents[i], page.tags[i])]
    before = np.zeros(n)
    seen = 0
    first = {}
    for node, text in page.runs:
        first.setdefault(node, seen)
        seen += len(text)
    for i in range(n):
        before[i] = first.get(i, before[parents[i]] if i else 0)
    x[:, 4:8] = under
    x[:, 8] = depth
    x[:, 9] = np.log1p(own)
    x[:, 10] = np.log1p(subtree)
    x[:, 11] = np.log1p(subtree / size)
    x[:, 12] = link_chars / np.maximum(1, subtree)
    x[:, 13] = np.log1p(links)
    x[:, 14] = marks / np.maximum(1, own)
    siblings = children[np.maximum(parents, 0)]
    x[:, 15] = place / np.maximum(1, siblings)
    x[:, 16] = np.log1p(siblings)
    x[:, 17] = np.log1p(same)
    x[:, 18] = np.log1p(np.maximum(0, subtree[np.maximum(parents, 0)] - subtree) / np.maximum(1, siblings))
    x[:, 19] = before / total
    x[:, 20] = subtree / total
    return x


def semantic_labels(x: np.ndarray) -> np.ndarray:
    """1: text, 0: not text, -1: the page's semantics do not say."""
    bad = (x[:, 4] > 0) | (x[:, 5] > 0)
    good = (x[:, 6] > 0) & ~bad
    labels = np.where(bad, 0, np.where(good, 1, -1))
    labels[x[:, 9] == 0] = -1
    labels[bad] = 0
    return labels


def views(x: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The labelled nodes as they are, and changed so that no single trait of the sample's pages decides.

    Tags, attributes or both are hidden, or the structural features are dealt out anew among all
    nodes; rejected nodes stand inside an article as well, and text nodes in praised elements.
    """
    random = np.random.default_rng(7)
    structure = [f for f in range(x.shape[1]) if f not in _TAGS + _WORDS]

    def dealt(nodes: np.ndarray) -> np.ndarray:
        out = nodes.copy()
        for f in structure:
            out[:, f] = x[random.integers(0, len(x), len(nodes)), f]
        return out

    def hidden(nodes: np.ndarray, columns: list[int]) -> np.ndarray:
        out = nodes.copy()
        out[:, columns] = 0
        return out

    shown = (x[:, _TAGS + _WORDS].sum(axis=1) > 0) & (labels == 0)
    rejected, praised = x[shown].copy(), x[labels == 1].copy()
    # As if by attributes only, and as if inside an article.
    worded = hidden(rejected, _TAGS)
    worded[:, _WORDS] = [1, 0, 1, 0]
    tagged = hidden(rejected, _WORDS)
    tagged[:, _TAGS] = [1, 0, 1, 0]
    # Ordinary paragraphs further down in either kind.
    below_word, below_tag = worded.copy(), tagged.copy()
    below_word[:, _WORDS], below_tag[:, _TAGS] = [0, 0, 1, 0], [0, 1, 1, 0]
    below_word[:, FEATURES.index("text_tag")] = 1
    inside = np.concatenate([rejected, worded, tagged, below_word, below_tag])
    inside[:, FEATURES.index("under_article")] = 1
    inside[::2, FEATURES.index("under_text_words")] = 1
    named = hidden(praised, [FEATURES.index("under_article")])
    named[:, FEATURES.index("under_text_words")] = 1
    no = np.zeros
    yes = np.ones
    parts = [
        (x, labels),
        (hidden(x, _TAGS), labels),
        (hidden(x, _WORDS), labels),
        (hidden(x, _TAGS + _WORDS), labels),
        *[(dealt(part), no(len(part))) for part in (rejected, worded, tagged, below_word, below_tag, inside)],
        *[(dealt(part), yes(len(part))) for part in (praised, praised, named, named)],
    ]
    return np.concatenate([a for a, _ in parts]), np.concatenate([b for _, b in parts]).astype(np.int64)


@dataclass
class Forest:
    """Complete trees of one depth: ``feature`` and ``threshold`` by node in level order, ``value`` by leaf."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += value[node - (2**DEPTH - 1)]
        return out


def boost(x: np.ndarray, y: np.ndarray) -> Forest:
    """Gradient boosting for log loss with Newton leaf values, on quantile bins."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    bins = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    share = min(max(y.mean(), 1e-3), 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    score = np.full(len(y), base)
    features, thresholds, values = [], [], []
    inner = 2**DEPTH - 1
    random = np.random.default_rng(11)
    for _ in range(TREES):
        # Half of the features to a tree, so that none stands in for all others.
        offered = sorted(random.choice(x.shape[1], -(-x.shape[1] // 2), replace=False).tolist())
        p = 1 / (1 + np.exp(-score))
        gradient, hessian = y - p, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(len(y), dtype=np.int64)
        feature, threshold = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
        for level in range(DEPTH):
            low, count = 2**level - 1, 2**level
            best = np.full(count, 1e-9)
            chosen = np.full((count, 2), -1)
            for f in offered:
                width = len(edges[f]) + 1
                if width < 2:
                    continue
                key = (node - low) * width + bins[:, f]
                g = np.bincount(key, gradient, count * width).reshape(count, width).cumsum(axis=1)
                h = np.bincount(key, hessian, count * width).reshape(count, width).cumsum(axis=1)
                gl, hl, gt, ht = g[:, :-1], h[:, :-1], g[:, -1:], h[:, -1:]
                gain = gl**2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt**2 / (ht + 1)
                at = gain.argmax(axis=1)
                top = gain[np.arange(count), at]
                better = top > best
                best[better], chosen[better, 0], chosen[better, 1] = top[better], f, at[better]
            for k in range(count):
                if chosen[k, 0] >= 0:
                    feature[low + k], threshold[low + k] = chosen[k, 0], edges[chosen[k, 0]][chosen[k, 1]]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > threshold[node])
        leaf = node - inner
        value = RATE * np.bincount(leaf, gradient, 2**DEPTH) / (np.bincount(leaf, hessian, 2**DEPTH) + 1)
        score += value[leaf]
        features.append(feature)
        thresholds.append(threshold)
        values.append(value)
    return Forest(base, np.array(features), np.array(thresholds), np.array(values))


def decode(page: Page, log_odds: np.ndarray) -> np.ndarray:
    """The labelling with the highest likelihood in which a kept node has only kept ancestors.

    A node weighs as much as its own text; one without text follows its descendants.
    """
    n = len(page.tags)
    weight = np.full(n, 1e-3)
    for node, text in page.runs:
        weight[node] += len(text)
    kept = (-np.logaddexp(0, -log_odds) * weight).tolist()
    dropped = (-np.logaddexp(0, log_odds) * weight).tolist()
    kept[0], dropped[0] = 0.0, -1e-9
    open_children = [False] * n
    parents = page.parents
    for i in range(n - 1, 0, -1):
        p = parents[i]
        open_children[i] = kept[i] > dropped[i]
        kept[p] += max(kept[i], dropped[i])
        dropped[p] += dropped[i]
    out = np.zeros(n, dtype=bool)
    out[0] = kept[0] > dropped[0]
    for i in range(1, n):
        out[i] = out[parents[i]] and open_children[i]
    return out


def main_text(page: Page, keep: np.ndarray) -> str:
    return "\n".join(text for node, text in page.runs if keep[node])


def _sample_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for source in batch.column("html").to_pylist():
            x = features(parse(source or ""))
            labels = semantic_labels(x)
            x, labels = x[labels >= 0], labels[labels >= 0]
            yield pa.RecordBatch.from_arrays([pa.array(labels, pa.int32()), *[pa.array(c) for c in x.T]], names=["label", *FEATURES])


def fit(pages: DataFrame) -> Forest | None:
    """A forest from at most ``SAMPLE_PAGES`` whole pages and ``SAMPLE_NODES`` of their labelled nodes, both chosen by hash."""
    work = Workspace(pages.sparkSession, "dom-boost")
    chosen = pages.select("page_id", F.xxhash64("page_id").alias("h")).distinct().orderBy("h", "page_id").limit(SAMPLE_PAGES).select("page_id")
    sample = pages.join(F.broadcast(work.save(chosen, "sample")), "page_id").select("html")
    schema = "label int, " + ", ".join(f"{f} double" for f in FEATURES)
    order = F.xxhash64("label", *FEATURES)
    rows: pd.DataFrame = sample.mapInArrow(_sample_rows, schema).withColumn("h", order).orderBy("h").limit(SAMPLE_NODES).drop("h").toPandas()
    rows = rows.sort_values(list(rows.columns))
    if rows["label"].nunique() < 2:
        return None
    return boost(*views(rows[FEATURES].to_numpy(), rows["label"].to_numpy()))


def _extract(forest: Forest | None):
    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, BATCH_PAGES):
                rows = batch.slice(low, BATCH_PAGES)
                pages = [parse(x or "") for x in rows.column("html").to_pylist()]
                xs = [features(p) for p in pages]
                if forest is None:
                    # Nothing to learn from: only what the semantics reject is left out.
                    odds = [np.where((x[:, 4] > 0) | (x[:, 5] > 0), -5.0, 5.0) for x in xs]
                else:
                    odds = np.split(forest.log_odds(np.concatenate(xs)), np.cumsum([len(x) for x in xs])[:-1])
                texts = [main_text(p, decode(p, o)) for p, o in zip(pages, odds, strict=True)]
                arrays = [rows.column("page_id"), rows.column("url"), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, names=["page_id", "url", "text"])

    return run


def extract_main_text(pages: DataFrame, forest: Forest | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` per row of ``pages(page_id, url, html)``.

    ``text`` holds the article's blocks, one to a line. A null or empty page, and one without an
    article, gives an empty text. Repeated rows are read each; null ids and urls are carried; other
    columns are ignored; an empty table gives none.
    """
    bounded_batches(pages.sparkSession)
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    forest = forest or fit(rows)
    kind = dict(rows.dtypes)["page_id"]
    texts = rows.mapInArrow(_extract(forest), f"page_id {kind}, url string, text string")
    return texts.withColumn("n_chars", F.char_length("text").cast("bigint"))
