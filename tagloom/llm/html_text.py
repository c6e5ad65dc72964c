"""Main text of web pages: boosted trees over the nodes of the page, decoded from the top.

**Nodes.** Pages are parsed to a tree that closes tags as browsers do. Each element that holds text is described by its
tag group, words in its class and id (its own and those above), text length, share of the page's text, density of text in
its subtree, links, punctuation, depth, and place and number among its siblings.

**Training.** Pages carry no labels, so the examples are made: texts of a bounded sample of pages are laid out anew in many
ways, as an article among menus, notices, adverts, forms, comments and side columns, with and without telling
tags and classes. Spark ML's gradient-boosted trees learn which nodes belong to the article; the trees then go
to the tasks as arrays, a few kilobytes.

**Decoding.** Every node adds its log odds to the choices *all of this subtree* and *none of it*; the third choice leaves
the decision to its children, at a cost. The best choice is found from the leaves up, so no node is taken under one that is
refused, or refused under one that is taken.

Text in scripts, styles, templates, the head and form controls is never text of the page. Blocks are runs of text between
block tags; a line break counts as white space.

Defined cases: null and empty html, and pages without an article, give an empty text; rows that repeat are read each;
pages are never cut, unclosed and broken tags are text or ignored as browsers do; an empty table gives no rows. Other
columns than the three named ones are not looked at.
"""

from __future__ import annotations

import html
import random
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.shared import hashed_sample

#: Bound of the pages whose texts are laid out anew, and layouts for each.
SAMPLE = 300
LAYOUTS = 3
TREES, DEPTH = 20, 5
SWITCH_COST = 0.5
_OPEN = re.compile(r"<(?:!--|([!?])|(/?)([a-zA-Z][a-zA-Z0-9:-]*))")
#: The rest of a tag, with marks of quotation heeded and not.
_TAG_END = re.compile(r"((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
_LOOSE_END = re.compile(r"([^>]*+)>")
#: Elements whose content is no text of the page: those that end with the page if they are not closed, and others.
_RAW, _HIDDEN = {"script", "style", "textarea", "iframe", "title"}, {"template", "noscript", "select", "svg"}
_MARK = re.compile(r'data-y="([01])"')
_ATTRIBUTE = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}
_BLOCK = set(
    "address article aside blockquote body button center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
_CLOSES_P = _BLOCK - {"body", "html", "head", "button", "td", "th", "tr", "tbody", "thead", "tfoot", "legend", "summary"}
_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_STOP = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
TAG_GROUPS = [{"article", "main"}, {"nav", "menu"}, {"header"}, {"footer"}, {"aside"}, {"form", "button", "fieldset", "label"}, {"p", "blockquote", "pre"}, {"h1", "h2", "h3", "h4", "h5", "h6"}, {"ul", "ol", "li", "dl", "dt", "dd"}, {"a"}, {"table", "tr", "td", "th"}, {"section", "div"}]
#: Groups of words in classes, ids and roles.
ATTRIBUTE_GROUPS = [
    {"ad", "ads", "advert", "advertisement", "adverts", "banner", "sponsor", "sponsored", "promo", "promotion"},
    {"nav", "navigation", "navbar", "menu", "breadcrumb", "breadcrumbs", "pagination", "pager", "toc", "tabs"},
    {"comment", "comments", "reply", "replies", "discussion", "disqus", "respond"},
    {"cookie", "cookies", "consent", "notice", "alert", "gdpr", "popup", "modal", "newsletter", "subscribe", "signup", "paywall"},
    {"sidebar", "side", "aside", "related", "widget", "recommended", "trending", "complementary", "share", "social"},
    {"footer", "foot", "copyright", "legal", "header", "masthead", "banner", "contentinfo", "topbar", "site"},
    {"content", "article", "post", "entry", "story", "main", "body", "text"},
    {"form", "search", "login", "contact"},
]
_ATTRIBUTE_OF = [(w, i) for i, g in enumerate(ATTRIBUTE_GROUPS) for w in g]
N_FEATURES = 2 * (len(TAG_GROUPS) + len(ATTRIBUTE_GROUPS)) + 15


@dataclass(slots=True)
class Node:
    tag: str
    parent: int
    depth: int
    place: int
    words: frozenset[int]
    mark: int | None = None
    own: int = 0
    total: int = 0
    linked: int = 0
    stops: int = 0
    count: int = 1
    children: list[int] = field(default_factory=list)


def _attribute_words(text: str) -> frozenset[int]:
    found = set()
    for match in _ATTRIBUTE.finditer(text):
        for word in re.split(r"[^a-z]+", (match[1] or match[2] or match[3] or "").lower()):
            found.update(i for w, i in _ATTRIBUTE_OF if w == word)
    return frozenset(found)


def tokens(source: str) -> Iterator[tuple[int, int, bool, str, str]]:
    """``start, end, whether it closes, tag, attributes`` of all markup, going forward only; comments and the like have no tag.

    A tag whose quotation never ends ends at the first ``>``, and so do all tags behind it. Hidden elements are passed over with
    their content; one that closes itself, or is never closed, is its tag alone, but for scripts and their like.
    """
    at, end_of, unclosed = 0, _TAG_END, set()
    while found := _OPEN.search(source, at):
        start, at = found.span()
        if found[3] is None:  # a comment or a declaration
            mark = ">" if found[1] else "-->"
            at = source.find(mark, at)
            at = len(source) if at < 0 else at + len(mark)
            yield start, at, False, "", ""
            continue
        rest = end_of.match(source, at)
        if rest is None and end_of is _TAG_END:
            end_of = _LOOSE_END
            rest = end_of.match(source, at)
        if rest is None:  # no tag ends any more: what is left is text, but for the last beginning of one
            start = source.rfind("<")
            if re.match("[a-zA-Z/!?]", source[start + 1 : start + 2]):
                yield start, len(source), False, "", ""
            return
        at, tag = rest.end(), found[3].lower()
        if (tag in _RAW or tag in _HIDDEN) and not found[2]:
            if not (rest[1].endswith("/") and tag == "svg") and tag not in unclosed:
                close = re.compile(rf"</{tag}\s*>", re.I).search(source, at)
                if close:
                    at = close.end()
                elif tag in _RAW:
                    at = len(source)
                else:
                    unclosed.add(tag)
            yield start, at, False, "", ""
            continue
        yield start, at, bool(found[2]), tag, rest[1]


def parse(source: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """The nodes, parents first, and the pieces of text with their node, in page order; a node of -1 is a block border."""
    nodes = [Node("#page", -1, 0, 0, frozenset())]
    pieces: list[tuple[int, str]] = []
    stack, blocks = [0], [0]  # open nodes, and the places of blocks among them
    where: dict[str, list[int]] = defaultdict(list)  # places of the open nodes of a tag
    head = False

    def close(upto: int) -> None:
        while len(stack) > upto:
            tag = nodes[stack.pop()].tag
            where[tag].pop()
            if tag in _BLOCK:
                blocks.pop()
                pieces.append((-1, ""))

    def last(tags) -> int:
        return max((where[t][-1] for t in tags if where[t]), default=0)

    def text(chunk: str) -> None:
        if chunk and not head:
            pieces.append((stack[-1], chunk))

    at = 0
    for start, end, closes, tag, attributes in tokens(source):
        text(source[at:start])
        at = end
        if not tag:
            continue
        if tag == "head":
            head = not closes
            continue
        if closes:
            place = last([tag])
            if place and (tag in _BLOCK or place > blocks[-1]):  # inside the innermost block, if it is none itself
                close(place)
            continue
        if tag == "br":
            text(" ")
            continue
        if tag in ("body", "frameset"):
            head = False
        if tag in _CLOSES_P and blocks[-1] and nodes[stack[blocks[-1]]].tag == "p":
            close(blocks[-1])
        if tag in _SAME:
            place = last(_SAME[tag])
            if place > last(_STOP[tag]):
                close(place)
        if tag in _BLOCK:
            pieces.append((-1, ""))
        if tag in _VOID or attributes.endswith("/") and tag not in _BLOCK:
            continue
        parent = stack[-1]
        named = "=" in attributes
        mark = _MARK.search(attributes) if named else None
        nodes.append(
            Node(tag, parent, len(stack), len(nodes[parent].children), _attribute_words(attributes) if named else frozenset(), int(mark[1]) if mark else None)
        )
        nodes[parent].children.append(len(nodes) - 1)
        where[tag].append(len(stack))
        if tag in _BLOCK:
            blocks.append(len(stack))
        stack.append(len(nodes) - 1)
    text(source[at:])
    return nodes, pieces


def measure(nodes: list[Node], pieces: list[tuple[int, str]]) -> np.ndarray:
    """Fills the sums of the nodes and returns their features."""
    for node, chunk in pieces:
        if node >= 0:
            size = len(chunk.strip())
            if size:
                nodes[node].own += size
                nodes[node].stops += sum(chunk.count(c) for c in ".,;:!?")
    link = [False] * len(nodes)
    for i, n in enumerate(nodes):
        link[i] = n.tag == "a" or (n.parent >= 0 and link[n.parent])
    for i in range(len(nodes) - 1, -1, -1):
        n = nodes[i]
        n.total += n.own
        n.linked += n.own if link[i] else 0
        if n.parent >= 0:
            p = nodes[n.parent]
            p.total += n.total
            p.linked += n.linked
            p.stops += n.stops
            p.count += n.count
    out = np.zeros((len(nodes), N_FEATURES))
    groups = len(TAG_GROUPS) + len(ATTRIBUTE_GROUPS)
    page = max(1, nodes[0].total)
    ended: list[int] = [0] * len(nodes)  # text before a node, as a place in the page
    before_of = [0] * len(nodes)
    alike: list[Counter] = [Counter() for _ in nodes]  # children of each tag
    for n in nodes[1:]:
        alike[n.parent][n.tag] += 1
    for i, n in enumerate(nodes):
        x = out[i]
        for g, tags in enumerate(TAG_GROUPS):
            x[g] = n.tag in tags
        for g in n.words:
            x[len(TAG_GROUPS) + g] = 1
        if n.parent < 0:
            continue
        above, siblings = out[n.parent], nodes[n.parent].children
        x[groups : 2 * groups] = np.maximum(above[:groups], above[groups : 2 * groups])
        before = nodes[siblings[n.place - 1]] if n.place else None
        after = nodes[siblings[n.place + 1]] if n.place + 1 < len(siblings) else None
        ended[i] = ended[n.parent] + before_of[n.parent]  # running sums and counts of the parent, over all its children so far
        before_of[n.parent] += n.total
        rest = np.array(
            [
                np.log1p(n.total), np.log1p(n.own), n.total / page, n.total / n.count, n.linked / max(1, n.total), n.stops / max(1, n.total),
                n.depth, n.place / max(1, len(siblings) - 1), np.log1p(len(siblings)), np.log1p(before.total) if before else -1,
                np.log1p(after.total) if after else -1, alike[n.parent][n.tag], ended[i] / page,
                n.total / max(1, nodes[n.parent].total), np.log1p(n.count),
            ]
        )
        x[2 * groups :] = rest
    return out


def layouts(paragraphs: list[str], title: str, fillers: list[str], seed: int) -> tuple[str, tuple[str, str]]:
    """A page around ``paragraphs`` with boilerplate of ``fillers``. Attributes ``data-y`` mark the article (1) and the rest (0)."""
    rng = random.Random(seed)
    plain = rng.random() < 0.25  # no telling tags
    bare = rng.random() < 0.3  # no telling classes
    words = lambda a, b: html.escape(" ".join(rng.choice(fillers) for _ in range(rng.randint(a, b))))

    def part(tag: str, group: int, inner: str) -> str:
        tag = "div" if plain and rng.random() < 0.6 else tag
        kind = "" if bare and tag != "div" else f' class="{rng.choice(sorted(ATTRIBUTE_GROUPS[group]))}"'
        return f'<{tag}{kind} data-y="0">{inner}</{tag}>'

    links = lambda: "<ul>" + "".join(f'<li><a href="/x">{words(1, 2)}</a></li>' for _ in range(rng.randint(3, 10))) + "</ul>"
    some = lambda: "".join(f"<p>{words(4, 40)}</p>" for _ in range(rng.randint(1, 4)))
    before = [part("nav", 1, links())]
    if rng.random() < 0.5:
        before.insert(0, part("header", 5, f"<p>{words(1, 6)}</p>"))
    if rng.random() < 0.6:
        before.append(part("div", 0, words(3, 14)))
    if rng.random() < 0.4:
        before.append(part("div", 3, f"<p>{words(6, 25)}</p><button>{words(1, 2)}</button>"))
    if rng.random() < 0.3:
        before.append(part("aside", 4, f"<h3>{words(1, 3)}</h3>{links() if rng.random() < 0.5 else some()}"))
    after = []
    if rng.random() < 0.4:
        after.append(part("aside", 4, f"<h2>{words(1, 4)}</h2>{links() if rng.random() < 0.5 else some()}"))
    if rng.random() < 0.5:
        after.append(part("section", 2, f"<h2>{words(1, 3)}</h2>" + "".join(f'<div class="comment"><b>{words(1, 2)}</b>{some()}</div>' for _ in range(rng.randint(1, 6)))))
    if rng.random() < 0.4:
        after.append(part("form", 7, f"<label>{words(1, 3)}</label><input><button>{words(1, 2)}</button>"))
    after.append(part("footer", 5, f"&copy; {words(3, 16)}"))
    body = []
    for k, p in enumerate(paragraphs):
        p = html.escape(p)
        body.append(f"<p><b>{p}<br>" if rng.random() < 0.1 else f"<p>{p}</p>")
        if rng.random() < 0.1:
            body.append(f"<h2>{words(2, 6)}</h2>")
        if rng.random() < 0.05:
            body.append(f"<ul><li>{words(4, 14)}</li><li>{words(4, 14)}</li></ul>")
        if rng.random() < 0.06:
            body.append(part("div", 0, words(3, 12)))
    tag = rng.choice(["article", "article", "main", "div", "section"])
    kind = f' class="{rng.choice(sorted(ATTRIBUTE_GROUPS[6]))}"' if rng.random() < 0.5 or (tag == "div" and plain) else ""
    article = f'<{tag}{kind} data-y="1"><h1>{html.escape(title)}</h1>{"".join(body)}</{tag}>'
    inside = "".join(before) + article + "".join(after)
    for _ in range(rng.randint(0, 2)):
        inside = f"<div>{inside}</div>"
    return f"<!DOCTYPE html><html><head><title>{html.escape(title)}</title></head><body>{inside}</body></html>"


def examples(source: str) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the nodes of a page made by :func:`layouts`; nodes that hold both kinds are left out."""
    nodes, pieces = parse(source)
    x = measure(nodes, pieces)
    label = [n.mark for n in nodes]
    for i, n in enumerate(nodes[1:], 1):
        label[i] = label[n.parent] if n.mark is None else n.mark
    mixed = [False] * len(nodes)
    for i in range(len(nodes) - 1, 0, -1):
        p = nodes[i].parent
        if mixed[i] or (label[p] is not None and label[i] is not None and label[i] != label[p]):
            mixed[p] = True
    use = [i for i, n in enumerate(nodes) if label[i] is not None and n.total and not mixed[i]]
    return x[use], np.array([label[i] for i in use], float)


@dataclass
class Forest:
    """Regression trees as arrays: feature (-1 at leaves), threshold, left and right child, value; a weight each."""

    trees: list[tuple[np.ndarray, ...]]
    weights: list[float]

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x))
        for (feature, threshold, left, right, value), weight in zip(self.trees, self.weights):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                f = feature[at]
                down = np.where(x[np.arange(len(x)), np.maximum(f, 0)] <= threshold[at], left[at], right[at])
                at = np.where(f < 0, at, down)
            out += weight * value[at]
        return 2 * out  # log odds, by the loss that the trees were fitted to


def _flat(root) -> tuple[np.ndarray, ...]:
    rows: list[list[float]] = []

    def walk(node) -> int:
        i = len(rows)
        rows.append([-1, 0.0, 0, 0, node.prediction()])
        if node.subtreeDepth() > 0:
            split = node.split()
            rows[i][:2] = [split.featureIndex(), split.threshold()]
            rows[i][2] = walk(node.leftChild())
            rows[i][3] = walk(node.rightChild())
        return i

    walk(root)
    columns = list(zip(*rows))
    return np.array(columns[0], np.int64), np.array(columns[1]), np.array(columns[2], np.int64), np.array(columns[3], np.int64), np.array(columns[4])


def train(pages: DataFrame, sample: int = SAMPLE, html_col: str = "html") -> Forest | None:
    """Fit the trees on new layouts of the texts of ``sample`` pages, chosen by a hash of the page."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector

    chosen = pages.select("page_id", F.col(html_col).cast("string").alias("html")).where("html <> ''")
    chosen = hashed_sample(chosen, sample).select("html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source in batch.column("html").to_pylist():
                nodes, pieces = parse(source)
                blocks = sorted({b for _, b in _blocks(nodes, pieces, None)}, key=len)
                paragraphs = [b for b in blocks if len(b) > 40][:30]
                words = " ".join(blocks).split()
                if not paragraphs or len(words) < 20:
                    continue
                for k in range(LAYOUTS):
                    rng = random.Random(len(source) * 7 + k)
                    some = [rng.choice(paragraphs)[: rng.randint(60, 900)] for _ in range(rng.randint(1, 14))]
                    x, y = examples(layouts(some, " ".join(words[:8]), words, len(source) * 31 + k))
                    lists = pa.ListArray.from_arrays(np.arange(0, x.size + 1, N_FEATURES, dtype=np.int32), x.ravel())
                    yield pa.RecordBatch.from_arrays([lists, pa.array(y)], names=["x", "label"])

    table = chosen.mapInArrow(run, "x array<double>, label double").select(array_to_vector("x").alias("features"), "label").cache()
    if table.select("label").distinct().count() < 2:
        return None
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=5, cacheNodeIds=False).fit(table)
    table.unpersist()
    return Forest([_flat(t._java_obj.rootNode()) for t in model.trees], list(model.treeWeights))


def decode(nodes: list[Node], margin: np.ndarray) -> list[bool]:
    """Whether each node belongs to the article; consistent along every path to the root."""
    n = len(nodes)
    all_in, free = np.zeros(n), np.zeros(n)
    for i in range(n - 1, -1, -1):
        if nodes[i].total:
            all_in[i] += margin[i]
        free[i] += -SWITCH_COST if nodes[i].own else 0.0
        p = nodes[i].parent
        if p >= 0 and nodes[i].total:
            all_in[p] += all_in[i]
            free[p] += max(all_in[i], -all_in[i], free[i] - SWITCH_COST)
    state = [0] * n  # 1 taken, -1 refused, 0 left to the children
    for i in range(n):
        above = state[nodes[i].parent] if nodes[i].parent >= 0 else 0
        if above:
            state[i] = above
        elif all_in[i] >= max(-all_in[i], free[i] - SWITCH_COST) and all_in[i] > 0:
            state[i] = 1
        elif -all_in[i] >= free[i] - SWITCH_COST:
            state[i] = -1
    return [s == 1 for s in state]


def _blocks(nodes: list[Node], pieces: list[tuple[int, str]], taken: list[bool] | None) -> Iterator[tuple[int, str]]:
    held: list[str] = []
    owner = -1
    for node, chunk in [*pieces, (-1, "")]:
        if node < 0:
            block = " ".join(html.unescape("".join(held)).split())
            if block:
                yield owner, block
            held = []
        elif taken is None or taken[node]:
            held.append(chunk)
            owner = node


def extract(sources: list[str | None], forest: Forest | None) -> list[str]:
    out = []
    parsed = [parse(s or "") for s in sources]
    features = [measure(*p) for p in parsed]
    margins = forest.margin(np.concatenate(features)) if forest and parsed else np.empty(0)
    at = 0
    for nodes, pieces in parsed:
        taken = decode(nodes, margins[at : at + len(nodes)]) if forest else [False] * len(nodes)
        at += len(nodes)
        out.append("\n".join(b for _, b in _blocks(nodes, pieces, taken)))
    return out


def main_texts(pages: DataFrame, forest: Forest | None) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages``."""
    shared = pages.sparkSession.sparkContext.broadcast(forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 100):
                part = batch.slice(k, 100)
                texts = extract(part.column("html").to_pylist(), shared.value)
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
