"""Main text of web pages by gradient-boosted trees over DOM-node features.

A page is parsed to a tree of block elements; text belongs to its nearest block. Each node has features of its tag, the
tokens of its class, id and role, its depth, the text and links of its subtree, and its place among its siblings. Trees
boosted in numpy give each node the chance of being main text. Decoding is hierarchical: a dynamic program over the tree
picks the likeliest labelling in which everything below a dropped node is dropped, so that no choice contradicts another.

There are no labelled pages. The trees are trained on pages that are put together from the paragraphs of a bounded sample
of the input's own pages and known boilerplate parts around them, under many kinds of mark-up.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.llm.common import among_least, read_table

#: Pages sampled for training, paragraphs drawn from each whole page and words of one, and pages put together from them.
SAMPLE_PAGES, SAMPLE_PARAGRAPHS, PARAGRAPH_WORDS, MADE_PAGES = 300, 30, 400, 900
#: Paragraphs for training where the sample has no text block at all.
SEEDS = ("The committee met on Monday to hear what had been found, and it will say more in spring.", "A short note on method.", "Rain fell on the hills for three days before the river rose, and nobody who lived there was surprised by it.")
TREES, DEPTH, BINS, RATE = 40, 4, 32, 0.3

TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)", re.S)
# A part of a tag behind its name, quotes closed, and all such parts.
PART, PARTS = (re.compile(p) for p in (r"""[^>"']+|"[^"]*"|'[^']*'""", r"""(?:[^>"']+|"[^"]*"|'[^']*')*+"""))
ATTRIBUTE = re.compile(r"""(class|id|role|data-y)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
SPLIT = re.compile(r"[^a-z0-9]+")
SPACE = re.compile(r"\s+")
# Fixed by HTML: elements without content, with raw content, inline elements, and those that an open p ends at.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template iframe textarea title svg select noembed noframes".split())
# Formulas stand within sentences, each of their parts an inline element.
MATH = frozenset("math annotation annotation-xml maction menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split())
INLINE = MATH | frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark object q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split())
SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}

#: Groups of tags and of attribute tokens, each a feature.
TAGS = [
    ("article", "main"), ("section",), ("div", "center"), ("p", "blockquote", "pre"), ("h1", "h2", "h3", "h4", "h5", "h6"), ("ul", "ol", "dl", "menu"), ("li", "dt", "dd"),
    ("nav",), ("header", "hgroup"), ("footer",), ("aside",), ("form", "fieldset", "button", "dialog"), ("table", "tbody", "thead", "tr", "td", "th"), ("body", "html"), ("head",), ("figure", "figcaption", "details", "address"),
]
TOKENS = [
    ("content", "article", "post", "entry", "story", "main", "text", "body", "prose"), ("nav", "menu", "navbar", "navigation", "breadcrumb", "breadcrumbs", "toc"),
    ("ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "promo", "banner"), ("sidebar", "aside", "widget", "related", "recommended", "rail", "complementary"),
    ("footer", "bottom", "copyright", "contentinfo"), ("header", "masthead", "top", "logo"), ("comment", "comments", "reply", "replies", "discussion", "respond"),
    ("cookie", "cookies", "notice", "consent", "alert", "popup", "modal", "gdpr", "overlay"), ("share", "social", "follow"), ("form", "login", "signup", "search", "subscribe", "newsletter"),
]
TAG_NO = {t: k for k, group in enumerate(TAGS) for t in group}
TOKEN_NO = {t: k for k, group in enumerate(TOKENS) for t in group}
N_FEATURES = len(TAGS) + 2 * len(TOKENS) + 16


@dataclass
class Page:
    """Block nodes in document order: parent, tag and token groups, label (-1: none); text runs as (node, text, in a link, starts a block)."""

    parent: list[int]
    tag: list[int]
    tokens: list[frozenset[int]]
    label: list[int]
    runs: list[tuple[int, str, bool, bool]]


def tag_end(text: str, at: int, lost: set[int]) -> int:
    """The place of the > that ends the tag whose name ends at ``at``, quoted ones passed over.

    Where quotes lead to none, it is the next > at all, or the text's end. Places between parts that lead to none are kept
    in ``lost``, so that no way is taken twice.
    """
    if not lost and (k := PARTS.match(text, at).end()) < len(text) and text[k] == ">":
        return k
    k, way = at, []
    while k not in lost and (part := PART.match(text, k)):
        way.append(k)
        k = part.end()
    if k not in lost and text.startswith(">", k):
        return k
    lost.update(way, [k])
    k = text.find(">", at)
    return k if k >= 0 else len(text)


def parse(text: str, labelled: bool = False) -> Page:
    """The page's block tree. Mark-up, comments, scripts, styles and other raw elements give no text.

    Labels are read from pages that are put together for training only (``labelled``). Time is linear in the page's size,
    however elements are nested or left open.
    """
    page = Page([-1], [TAG_NO["html"]], [frozenset()], [-1], [])
    # Open elements, the block of their text, and the place of the nearest one at or below that isn't inline.
    stack: list[tuple[str, int, int]] = [("#root", 0, 0)]
    opened: Counter = Counter()

    def leave(k: int) -> int:
        """Closes the elements from place k on; how many links are among them."""
        gone = [x for x, _, _ in stack[k:]]
        del stack[k:]
        opened.subtract(gone)
        return gone.count("a")

    links, fresh, at, n = 0, True, 0, len(text)
    lost: set[int] = set()
    while at < n:
        m = TOKEN.search(text, at)
        end = m.start() if m else n
        if end > at and (run := text[at:end]):
            page.runs.append((stack[-1][1], entities.unescape(run) if "&" in run else run, links > 0, fresh))
            fresh = False
        if not m:
            break
        at = m.end()
        closing, name = m[1], m[2]
        if not name:
            if m[0].startswith("<![CDATA["):
                page.runs.append((stack[-1][1], m[0][9:].removesuffix("]]>"), links > 0, fresh))
            continue
        name, stop = name.lower(), tag_end(text, at, lost)
        attributes, at = text[at:stop], stop + 1
        if closing:
            if opened[name] > 0:
                links -= leave(next(k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == name))
            fresh = fresh or name not in INLINE
            continue
        if name in VOID:
            fresh = fresh or name != "wbr"
            continue
        if name in RAW:
            if not attributes.rstrip().endswith("/") or name != "svg":
                close = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(text, at)
                at = close.end() if close else n
            continue
        if name in INLINE:
            links += name == "a"
            stack.append((name, stack[-1][1], stack[-1][2]))
            opened[name] += 1
            continue
        fresh = True
        ends = SAME.get(name, ("p",) if name in ENDS_P else ())
        while stack[k := stack[-1][2]][0] in ends:
            links -= leave(k)
            if name != "tr":
                break
        tokens, label = frozenset(), -1
        if attributes and not attributes.isspace():
            found = {a[0].lower(): a[1].strip("\"'") for a in ATTRIBUTE.findall(attributes)}
            if found:
                given = found.pop("data-y", None)
                label = int(given) if labelled and given else -1
                tokens = frozenset(TOKEN_NO[t] for v in found.values() for t in SPLIT.split(v.lower()) if t in TOKEN_NO)
        page.parent.append(stack[-1][1])
        page.tag.append(TAG_NO.get(name, -1))
        page.tokens.append(tokens)
        page.label.append(label)
        stack.append((name, len(page.parent) - 1, len(stack)))
        opened[name] += 1
    return page


def features(page: Page) -> np.ndarray:
    """One row for each node."""
    n = len(page.parent)
    parent = np.array(page.parent)
    out = np.zeros((n, N_FEATURES), np.float32)
    chars, linked, runs, stops, own = (np.zeros(n) for _ in range(5))
    for node, text, link, _ in page.runs:
        size = len(text.strip())
        if size:
            own[node] += size
            chars[node] += size
            runs[node] += 1
            linked[node] += size * link
            stops[node] += text.count(".") + text.count(",")
    nodes, depth, children, index = np.ones(n), [0] * n, [0] * n, [0] * n
    above: list[frozenset[int]] = [frozenset()] * n
    tags, tokens = [frozenset()] * n, page.tokens
    for i in range(1, n):
        p = page.parent[i]
        depth[i], index[i] = depth[p] + 1, children[p]
        children[p] += 1
        above[i] = above[p] | tokens[p] if tokens[p] else above[p]
        tags[i] = tags[p] | {page.tag[p]} if page.tag[p] in MARKING else tags[p]
    for i in range(n - 1, 0, -1):
        p = page.parent[i]
        chars[p] += chars[i]
        linked[p] += linked[i]
        runs[p] += runs[i]
        stops[p] += stops[i]
        nodes[p] += nodes[i]
    t, k = len(TAGS), len(TOKENS)
    for i in range(n):
        if page.tag[i] >= 0:
            out[i, page.tag[i]] = 1
        for x in tokens[i]:
            out[i, t + x] = 1
        for x in above[i]:
            out[i, t + k + x] = 1
        for x in tags[i]:
            out[i, t + 2 * k + MARKING[x]] = 1
    kids, up = np.array(children, float), np.maximum(parent, 0)
    rest = np.stack(
        [
            np.array(depth), np.log1p(chars), np.log1p(own), linked / np.maximum(chars, 1), chars / max(chars[0], 1), chars / np.maximum(chars[up], 1), np.log1p(chars / nodes),
            stops / np.maximum(chars, 1), kids, np.log1p(kids[up]), np.array(index) / np.maximum(kids[up], 1),
        ], 1,
    )
    out[:, N_FEATURES - 11 :] = rest
    return out


#: Tags whose subtrees are marked, and their feature.
MARKING = {TAG_NO[t]: k for k, t in enumerate(("nav", "footer", "aside", "form", "article"))}


@dataclass
class Trees:
    """Boosted trees over binned features: for each tree and inner node its feature and bin; leaf values."""

    edges: list[np.ndarray]
    feature: np.ndarray
    split: np.ndarray
    leaf: np.ndarray
    start: float

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(self.edges)], 1).astype(np.uint8)

    def raw(self, b: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(b), self.start), np.arange(len(b))
        for feature, split, leaf in zip(self.feature, self.split, self.leaf):
            at = np.zeros(len(b), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (b[rows, feature[at]] > split[at])
            out += leaf[at - (2**DEPTH - 1)]
        return out

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.raw(self.binned(x)), -12, 12)


def boost(x: np.ndarray, y: np.ndarray) -> Trees:
    """Newton boosting of the logistic loss with trees of full depth over feature histograms."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS)[1:-1])) for f in range(x.shape[1])]
    mean = min(max(y.mean(), 0.01), 0.99)
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    model = Trees(edges, np.zeros((TREES, inner), np.int64), np.full((TREES, inner), 255), np.zeros((TREES, leaves)), float(np.log(mean / (1 - mean))))
    b = model.binned(x)
    z = np.full(len(y), model.start)
    for tree in range(TREES):
        p = 1 / (1 + np.exp(-z))
        g, h = p - y, p * (1 - p)
        at = np.zeros(len(y), np.int64)
        for level in range(DEPTH):
            first, many = 2**level - 1, 2**level
            best = np.full(many, 1e-6)
            for f in range(x.shape[1]):
                if not len(edges[f]):
                    continue
                width = len(edges[f]) + 1
                cell = (at - first) * width + b[:, f]
                gs, hs = (np.bincount(cell, v, many * width).reshape(many, width).cumsum(1) for v in (g, h))
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + 1) + (gt - gs) ** 2 / (ht - hs + 1) - gt**2 / (ht + 1)
                cut = gain.argmax(1)
                better = gain[np.arange(many), cut] > best
                best[better] = gain[np.arange(many), cut][better]
                node = first + np.flatnonzero(better)
                model.feature[tree, node], model.split[tree, node] = f, cut[better]
            at = 2 * at + 1 + (b[np.arange(len(y)), model.feature[tree][at]] > model.split[tree][at])
        k = at - inner
        model.leaf[tree] = -RATE * np.bincount(k, g, leaves) / (np.bincount(k, h, leaves) + 1)
        z += model.leaf[tree][k]
    return model


def decode(parent: list[int], odds: np.ndarray) -> list[bool]:
    """Which nodes are kept in the likeliest labelling whose dropped subtrees are dropped whole."""
    yes, no = -np.logaddexp(0, -odds), -np.logaddexp(0, odds)
    keep, drop = yes.tolist(), no.tolist()
    for i in range(len(parent) - 1, 0, -1):
        p = parent[i]
        keep[p] += max(keep[i], drop[i])
        drop[p] += drop[i]
    out = [keep[0] >= drop[0]] * len(parent)
    for i in range(1, len(parent)):
        out[i] = out[parent[i]] and keep[i] >= drop[i]
    return out


def kept_text(page: Page, keep: list[bool]) -> str:
    """The text of kept nodes: white space as one space within a block, blocks joined by one space."""
    parts, between = [], False
    for node, text, _, fresh in page.runs:
        between = between or fresh
        if keep[node]:
            parts.append(" " + text if between else text)
            between = False
    return SPACE.sub(" ", "".join(parts)).strip()


def paragraphs(html: str) -> tuple[bool, list[str]]:
    """Whether the page has an article or main element, and paragraphs drawn from all of it, or else from all of the page.

    At most SAMPLE_PARAGRAPHS, drawn by the page's own text; of a paragraph a run of PARAGRAPH_WORDS words.
    """
    page = parse(html)
    inside = [t == TAG_NO["article"] for t in page.tag]
    for i in range(1, len(inside)):
        inside[i] = inside[i] or inside[page.parent[i]]
    marked = any(inside)
    own: dict[int, list[str]] = {}
    for node, text, _, _ in page.runs:
        if inside[node] or not marked:
            own.setdefault(node, []).append(text)
    found = [w for parts in own.values() if (w := " ".join(parts).split())]
    rng = np.random.default_rng(zlib.crc32(html.encode("utf-8", "replace")))
    out = []
    for k in np.sort(rng.permutation(len(found))[:SAMPLE_PARAGRAPHS]).tolist():
        at = int(rng.integers(max(1, len(found[k]) - PARAGRAPH_WORDS + 1)))
        out.append(" ".join(found[k][at : at + PARAGRAPH_WORDS]).replace("&", "&amp;"))
    return marked, out


def made_pages(bare: list[str], seed: int = 3) -> list[str]:
    """Training pages: these paragraphs as main text, boilerplate parts around and within, labels in data-y."""
    rng = np.random.default_rng(seed)
    pick = lambda options: options[int(rng.integers(len(options)))]
    words = lambda n: " ".join(pick(bare).split()[:n]).replace("<", "&lt;")

    def box(tags: str, names: str, content: str, y: int, p: float = 0.7) -> str:
        tag = pick(tags.split())
        mark = pick(["", f' class="{pick(names.split())}"', f' id="{pick(names.split())}"', f' class="{pick(names.split())} {pick(["box", "wide", "x1"])}"']) if tag in ("div", "section", "ul") or rng.random() > p else ""
        if tag in ("div", "section", "ul") and not mark and rng.random() < 0.8:
            mark = f' class="{pick(names.split())}"'
        return f'<{tag}{mark} data-y="{y}">{content}</{tag}>'

    def listing(n: int) -> str:
        items = "".join(f'<li data-y="0"><a href="#">{words(int(rng.integers(1, 5)))}</a></li>' for _ in range(n))
        return f'<ul data-y="0">{items}</ul>'

    out = []
    for _ in range(MADE_PAGES):
        text = "".join(
            pick([f'<p data-y="1">{words(400)}</p>', f'<p data-y="1">{words(int(rng.integers(1, 30)))}</p>', f'<p data-y="1"><b>{words(20)}</b><br>', f'<blockquote data-y="1">{words(60)}</blockquote>', f'<ul data-y="1"><li data-y="1">{words(12)}</li><li data-y="1">{words(9)}</li></ul>', f'<h2 data-y="1">{words(6)}</h2><p data-y="1">{words(80)}</p>'])
            for _ in range(int(rng.integers(1, 9)))
        )
        middle = [pick([text, text, f'<div data-y="1">{text}</div>'])]
        if rng.random() < 0.2:
            middle.insert(int(rng.integers(2)), box("div aside", "ad ads advert sponsored promo share related", f'<p data-y="0">{words(15)}</p>', 0))
        main = box("article article main div section", "content article post entry-content story main post-body text", pick(["", f'<h1 data-y="1">{words(int(rng.integers(2, 14)))}</h1>']) + "".join(middle), 1)
        comments = "".join(box("div li p", "comment reply comment-body", words(int(rng.integers(3, 40))), 0) for _ in range(int(rng.integers(1, 5))))
        before = [
            (0.5, box("header div", "header masthead top", pick(["", f'<h1 data-y="0">{words(3)}</h1>']) + pick(["", words(4)]), 0)), (0.8, box("nav div ul", "nav menu navbar navigation", listing(int(rng.integers(2, 9))), 0)),
            (0.3, box("div", "notice cookie-consent alert cookies", f'<p data-y="0">{words(25)}</p>', 0)), (0.6, box("div aside", "ad advert ads banner sponsored", pick([words(14), f'<p data-y="0">{words(14)}</p>']), 0)),
            (0.3, box("aside div", "sidebar widget related", listing(int(rng.integers(1, 6))) + pick(["", f'<p data-y="0">{words(40)}</p>']), 0)),
        ]
        after = [
            (0.3, box("section div", "comments discussion respond", comments, 0)), (0.3, box("form div", "form login newsletter search signup", f'<p data-y="0">{words(10)}</p><input>', 0, 0.9)),
            (0.3, box("aside div", "sidebar widget related", listing(int(rng.integers(1, 6))), 0)), (0.9, box("footer div", "footer bottom copyright", pick([words(16), f'<p data-y="0">{words(16)}</p>', listing(4)]), 0)),
        ]
        head, tail = ("".join(t for p, t in part if rng.random() < p) for part in (before, after))
        whole = head + main + tail
        out.append(f"<html><head><title>{words(8)}</title></head><body>{whole if rng.random() < 0.7 else f'<div data-y=\"1\">{whole}</div>'}</body></html>")
    return out


def train(pages: list[str]) -> Trees:
    """Trees for pages like these; for any pages, as the labels and boilerplate are made."""
    return fit([paragraphs(p) for p in pages])


def fit(sample: list[tuple[bool, list[str]]]) -> Trees:
    """Trees from each page's paragraphs: those of articles, else all, else seeds."""
    bare = [t for marked, own in sample if marked for t in own] or [t for _, own in sample for t in own] or list(SEEDS)
    made = [parse(p, labelled=True) for p in made_pages(bare)]
    x = np.concatenate([features(p) for p in made])
    y = np.concatenate([[1 if i == 0 or p.tag[i] == TAG_NO["body"] or l == 1 else 0 for i, l in enumerate(p.label)] for p in made])
    return boost(x, y.astype(float))


def training_sample(pages: DataFrame) -> list[tuple[bool, list[str]]]:
    """The paragraphs of the pages of smallest hashed text, drawn in tasks from whole pages; equal pages count once."""
    hashed = pages.where("html is not null").withColumn("_h", F.xxhash64("html"))
    few = hashed.select("_h").where(among_least(F.col("_h"), SAMPLE_PAGES, pages.count()))
    least = F.broadcast(few.distinct().orderBy("_h").limit(SAMPLE_PAGES))
    rows = hashed.join(least, "_h").select("_h", "html").dropDuplicates(["_h"])

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = [paragraphs(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([m for m, _ in own], pa.bool_()), pa.array([t for _, t in own], pa.list_(pa.string()))], ["h", "marked", "own"])

    return [(r["marked"], r["own"]) for r in rows.mapInArrow(draw, "h long, marked boolean, own array<string>").orderBy("h").collect()]


def extract(pages: DataFrame, model: Trees, key: str = "page_id", html: str = "html") -> DataFrame:
    """``key`` and ``url`` and the main text and its length of every page.

    A null or empty page has empty text, as has one in which nothing is kept.
    Repeated rows are treated alike. Pages are cut into batches of bounded size for the trees, never in themselves.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)  # a few KB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = []
            for k in range(0, batch.num_rows, 200):
                parsed = [parse(t.as_py() or "") for t in batch.column(2).slice(k, 200)]
                odds = model.log_odds(np.concatenate([features(p) for p in parsed]))
                cuts = np.cumsum([len(p.parent) for p in parsed])[:-1]
                texts += [kept_text(p, decode(p.parent, o)) for p, o in zip(parsed, np.split(odds, cuts))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col(key).cast("long").alias("page_id"), "url", html).mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = read_table(spark, sf_dir, "pages", "page_id", "url", "html")
    return extract(pages, fit(training_sample(pages)))


#: The pages of these tables hold their text in one article each, so that SQL can cut it out.
OP4_SQL = r"""
with a as (select page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article[^>]*>(.*?)(</article>|$)', 1) as t from pages),
s as (select page_id, url, regexp_replace(regexp_replace(t, '</?b>', '', 'g'), '<[^>]*>', ' ', 'g') as t from a),
d as (select page_id, url, replace(regexp_replace(replace(replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;?', chr(1), 'g'), chr(1), '&') as t from s),
r as (select page_id, url, trim(regexp_replace(t, '\s+', ' ', 'g')) as text from d)
select page_id, url, text, length(text) as n_chars from r
"""
