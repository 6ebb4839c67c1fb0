"""Main text of web pages: gradient-boosted trees over DOM-node features, decoded over the tree.

Each page is parsed into its block elements. A node's features are its kind of tag, its attribute tokens
(words of class, id, role and the like found in lists of usual names), depth, sizes and densities of its subtree (text by
tag, link share, paragraphs, sentence marks) and its siblings (number, place, share of the text), with the
same of its parent. The trees (`gbt`) give log odds of being main text; half of the parent's are passed
down. Decoding keeps the subset of nodes with the largest weighted sum in which no node is kept under one that isn't.

Labels come from the pages' own semantic markup on a bounded sample (``TRAIN_PAGES`` pages): inside
article or main, and not inside navigation and the like, is main text. So that the trees don't lean on
those tags alone, they also learn from variants of these pages whose tags are changed to plain ones with or
without telling attributes, and with comment, notice and sidebar blocks put in.

Text: character references decoded, white space inside a block one space, blocks by one newline.

Defined cases: null or empty html, or html without text, gives an empty text; null url passes; pages are handled
each on its own, so repeated rows get equal results; without pages to learn from all text is kept that isn't in
`HIDDEN` elements; an empty table gives no rows; nesting has no limit; other columns pass through unless
called text or n_chars. Elements that are neither blocks nor links (math, object, svg and the like) are part of the
text around them, and their fallback text is text.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starhouse.llm.gbt import GBT

TRAIN_PAGES = 250

# HTML element names by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style template iframe head title select textarea datalist".split())
IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
CHROME = frozenset("nav footer aside header form menu button fieldset dialog label legend".split())
MAIN = frozenset("article main".split())
BLOCK = HIDDEN | CHROME | MAIN | frozenset(
    "address blockquote body center dd details dir div dl dt figcaption figure h1 h2 h3 h4 h5 h6 hgroup hr html li noscript ol "
    "optgroup option p pre section summary table tbody td tfoot th thead tr ul caption".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
ENDS_P = BLOCK - frozenset("button".split())
# Usual words in class, id and role of parts around the main text, and of the main text.
AROUND = frozenset(
    "ad ads advert advertisement advertising adsense sponsor sponsored promo promotion banner nav navbar navigation navigate menu menubar breadcrumb "
    "breadcrumbs header masthead topbar footer foot colophon copyright sidebar side aside complementary rail widget related recommended "
    "recommendation recommendations popular trending share sharing social follow comment comments respond reply replies disqus discussion notice notices cookie "
    "cookies consent gdpr alert popup modal overlay newsletter subscribe subscription signup login signin register search form contentinfo "
    "pagination pager toolbar tags meta skip legal disclaimer paywall outbrain taboola".split())
INSIDE = frozenset("article content contents main story post entry body text blog page prose copy hentry".split())
_TOKEN = re.compile(r"[a-z]+|[A-Z][a-z]*")


class Node:
    __slots__ = ("tag", "tokens", "parts", "parent", "chars", "links", "tags", "paras", "marks", "depth", "about")

    def __init__(self, tag: str, tokens: list[str], parent):
        self.tag, self.tokens, self.parent, self.parts = tag, tokens, parent, []
        self.about = None
        self.depth = parent.depth + 1 if parent else 0

    @property
    def children(self):
        return [p for p in self.parts if isinstance(p, Node)]


class _Tree(HTMLParser):
    """Block elements with their text; inline elements only mark link text (a part is text, is_link)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("html", [], None)
        self.open: list[str] = []
        self.linked = 0

    def handle_starttag(self, tag, attrs):
        if tag == "body" or self.at.tag == "head" and tag not in IN_HEAD:   # </head> may be left out
            self._close("head", frozenset())
        if tag == "br" or tag in VOID:
            self.at.parts.append((" ", False))
            return
        if tag == "a":
            self.linked += 1
            return
        if tag not in BLOCK or tag in ("html", "body"):
            return
        if tag in ENDS_P:
            self._close("p", BLOCK - HEADING - {"p", "ul", "ol"} if tag != "p" else frozenset("table td th article section div".split()))
        for same, stop in ((("li",), ("ul", "ol", "menu")), (("dd", "dt"), ("dl",)), (("td", "th"), ("tr", "table")), (("tr",), ("table",)), (("option",), ("select",))):
            if tag in same:
                for s in same:
                    self._close(s, frozenset(stop))
        self.linked = 0
        tokens = [t.lower() for k, v in attrs if v and k in ("class", "id", "role", "itemprop", "aria-label") for t in _TOKEN.findall(v)]
        node = Node(tag, tokens, self.at)
        self.at.parts.append(node)
        self.at = node

    def _close(self, tag, stop):
        n = self.at
        while n is not self.root and n.tag != tag:
            if n.tag in stop:
                return
            n = n.parent
        if n is not self.root:
            self.at = n.parent
            self.linked = 0

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag in BLOCK:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag == "a":
            self.linked = max(0, self.linked - 1)
        elif tag in BLOCK and tag not in ("html", "body"):
            self._close(tag, frozenset())

    def handle_data(self, data):
        if self.at.tag == "head" and data.strip():
            self._close("head", frozenset())
        self.at.parts.append((data, self.linked > 0))


def parse(html: str | None) -> Node:
    tree = _Tree()
    tree.feed(html or "")
    tree.close()
    return tree.root


def nodes_of(root: Node) -> list[Node]:
    """All nodes, parents first, with subtree sums filled in."""
    order, stack = [], [root]
    while stack:
        n = stack.pop()
        order.append(n)
        stack += reversed(n.children)
    for n in reversed(order):
        own = [p for p in n.parts if not isinstance(p, Node)]
        texts = [" ".join(t.split()) for t, _ in own]
        hidden = n.tag in HIDDEN
        n.chars = 0 if hidden else sum(map(len, texts))
        n.links = 0 if hidden else sum(len(t) for t, (_, link) in zip(texts, own, strict=True) if link)
        n.marks = 0 if hidden else sum(t.count(".") + t.count(",") for t in texts)
        n.tags, n.paras = 1, int(n.tag == "p")
        for c in n.children:
            n.chars += c.chars
            n.links += c.links
            n.marks += c.marks
            n.tags += c.tags
            n.paras += c.paras
    return order


def _own(n: Node) -> list[float]:
    t = n.tag
    return [t in HIDDEN, t in CHROME, t in MAIN, t in HEADING, t == "p", t in ("li", "ul", "ol", "dl"), t in ("table", "tr", "td", "th", "tbody"),
            sum(x in AROUND for x in n.tokens), sum(x in INSIDE for x in n.tokens), np.log1p(n.chars), n.chars / n.tags,
            n.links / max(1, n.chars), np.log1p(n.paras), n.marks / max(1, n.chars)]


def features(order: list[Node]) -> np.ndarray:
    own = {id(n): _own(n) for n in order}
    siblings = {id(n): n.parent.children if n.parent else [n] for n in order}
    rows = []
    for n in order:
        sib = siblings[id(n)]
        up = own[id(n.parent)] if n.parent else [0.0] * len(own[id(n)])
        whole = n.parent.chars if n.parent else n.chars
        rows.append(own[id(n)] + up + [n.depth, len(sib), n.chars / max(1, whole), sum(s.tag == n.tag for s in sib) / len(sib)])
    places = {id(c): i / max(1, len(n.children) - 1) for n in order for i, c in enumerate(n.children)}
    return np.column_stack([np.array(rows, dtype=float), [places.get(id(n), 0.0) for n in order]])


def keep_nodes(order: list[Node], margin: np.ndarray) -> set[int]:
    """Ids of the kept nodes: the best subset that is closed towards the root."""
    odds, best, kept = {}, {}, set()
    for n, m in zip(order, margin, strict=True):
        odds[id(n)] = float(np.clip(m + (0.5 * odds[id(n.parent)] if n.parent else 0.0), -8, 8))
    for n in reversed(order):
        best[id(n)] = odds[id(n)] * np.log(2 + n.chars) + sum(max(0.0, best[id(c)]) for c in n.children)
    for n in order:
        if n.parent is None or id(n.parent) in kept and best[id(n)] > 0 and n.tag not in HIDDEN:
            kept.add(id(n))
    return kept


def text_of(root: Node, kept: set[int]) -> str:
    """Blocks of the kept nodes in page order."""
    blocks, line = [], []

    def flush():
        text = " ".join("".join(line).split())
        if text:
            blocks.append(text)
        line.clear()

    stack: list = [root]
    while stack:
        p = stack.pop()
        if p is None:
            flush()
        elif not isinstance(p, Node):
            line.append(p[0])
        else:
            flush()
            if id(p) in kept:
                stack += [None, *reversed(p.parts)]
    flush()
    return "\n".join(blocks)


def _label(order: list[Node]) -> np.ndarray | None:
    """1: most of the node's text is main text by semantic markup; None if the page has no such markup."""
    inside, good = {}, {}
    if not any(n.about or n.tag in MAIN for n in order):
        return None
    for n in order:
        at = inside.get(id(n.parent), 0)
        if n.about == "main" or n.about is None and n.tag in MAIN:
            at = 1
        if n.about == "around" or n.about is None and (n.tag in CHROME | HIDDEN or any(t in AROUND for t in n.tokens) and n.tag not in MAIN):
            at = 0
        inside[id(n)] = at
    for n in reversed(order):
        direct = n.chars - sum(c.chars for c in n.children)
        good[id(n)] = inside[id(n)] * direct + sum(good[id(c)] for c in n.children)
    return np.array([1.0 if (good[id(n)] > 0.5 * n.chars if n.chars else inside[id(n)]) else 0.0 for n in order])


def _vary(root: Node, rng: np.random.Generator) -> None:
    """Change tags and attributes of a labelled page, and put in blocks that aren't main text."""
    order = nodes_of(root)
    around, inside, chrome = sorted(AROUND), sorted(INSIDE), sorted(CHROME)
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    mains = [n for n in order if n.tag in MAIN]
    paras = [n for n in order if n.tag == "p" and n.chars]
    for n in order:
        if n.tag in CHROME or any(t in AROUND for t in n.tokens):
            n.about = "around"
            n.tag, n.tokens = [("div", [pick(around)]), (pick(chrome), []), (pick(["div", "section", "ul"]), [pick(around), "box"]), (pick(["div", "section"]), [])][
                int(rng.choice(4, p=[0.4, 0.25, 0.25, 0.1]))]
    for n in mains:
        n.about = "main"
        n.tag, n.tokens = [("main", []), ("article", []), ("div", [pick(inside)]), ("section", [pick(inside), "wrap"]), ("div", [])][
            int(rng.choice(5, p=[0.15, 0.25, 0.3, 0.15, 0.15]))]
        for _ in range(int(rng.integers(0, 4))):
            host = n if rng.random() < 0.5 else n.parent
            tag, tokens = [("div", [pick(around)]), (pick(chrome), []), ("section", [pick(around)]), ("ul", [pick(around)])][int(rng.integers(4))]
            box = Node(tag, tokens, host)
            box.about = "around"
            for _ in range(int(rng.integers(1, 4))):
                child = Node(pick(["p", "div", "li"]), [], box)
                words = [w for p in pick(paras).parts if not isinstance(p, Node) for w in p[0].split()] if paras else ["word"]
                child.parts = [(" ".join(words[:int(rng.integers(1, 60))]), rng.random() < 0.4)]
                box.parts.append(child)
            host.parts.insert(int(rng.integers(len(host.parts) + 1)), box)

    for n in nodes_of(root):                       # parents first
        n.depth = n.parent.depth + 1 if n.parent else 0


def train(htmls: list[str]) -> GBT:
    rng = np.random.default_rng(11)
    xs, ys = [], []
    for html in htmls:
        for variant in range(3):
            root = parse(html)
            if variant:
                _vary(root, rng)
            order = nodes_of(root)
            y = _label(order)
            if y is not None:
                xs.append(features(order))
                ys.append(y)
    model = GBT()
    if not xs:
        width = features(nodes_of(parse("")))
        model.fit(width[:0], np.zeros(0))
        model.bias = 1.0
        return model
    return model.fit(np.concatenate(xs), np.concatenate(ys))


def learned_from(pages: DataFrame) -> DataFrame:
    """At most ``TRAIN_PAGES`` different pages with semantic markup. They are chosen by their hashes, so a page that
    many rows hold counts once; only chosen ones are moved."""
    some = pages.where("html IS NOT NULL").where(F.lower("html").rlike("<(article|main)[ >]")).select("html", F.xxhash64("html").alias("h"))
    chosen = some.groupBy("h").count().orderBy("h").limit(TRAIN_PAGES).select("h")
    return some.join(F.broadcast(chosen), "h").groupBy("h").agg(F.min("html").alias("html"))


def fit(pages: DataFrame) -> bytes:
    """A model from the pages of `learned_from`, trained in one task."""

    def trained(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        htmls = [h for b in batches for h in b["html"]]
        yield pd.DataFrame({"model": [pickle.dumps(train(htmls))]})

    made = learned_from(pages).repartition(1).sortWithinPartitions("h").mapInPandas(trained, "model binary").collect()
    return bytes(made[0].model) if made else pickle.dumps(train([]))


def extract_one(html: str | None, model: GBT) -> str:
    root = parse(html)
    order = nodes_of(root)
    if not root.chars:
        return ""
    return text_of(root, keep_nodes(order, model.margin(features(order))))


def extract(pages: DataFrame, model: bytes) -> DataFrame:
    """``pages`` with the main text of each page, and its code points."""
    sent = pages.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = pickle.loads(sent.value)
        for batch in batches:
            out = []
            for a in range(0, len(batch), 64):      # trees of some pages at a time
                roots = [parse(h) for h in batch.iloc[a:a + 64]]
                orders = [nodes_of(r) for r in roots]
                margins = model.margin(np.concatenate([features(o) for o in orders]))
                at = 0
                for r, o in zip(roots, orders, strict=True):
                    out.append(text_of(r, keep_nodes(o, margins[at:at + len(o)])) if r.chars else "")
                    at += len(o)
            yield pd.Series(out, dtype=object)

    keep = [c for c in pages.columns if c not in ("text", "n_chars")]
    return pages.select(*keep, text("html").alias("text")).withColumn("n_chars", F.length("text").cast("long"))
