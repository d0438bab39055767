"""Main text of web pages by a tree-structured graphical model.

The block elements of a page are the nodes of a tree; each is content or not. A node has a potential of its own, from
what its element looks like, and one with its parent. Sum-product messages, upward from the leaves and then downward
from the root, give every node its exact marginal. The text of nodes that are content with a marginal above one half,
block by block, is the main text. Both potentials are trained from labelled pages: a few written for this purpose, whose
labels are attributes, and a bounded sample of the given pages whose markup names its article.
"""

from __future__ import annotations

import html
import math
import re
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seasonlens.llm.arrow import with_columns

#: pages of the given table to train from at most; those with the smallest hash of their id
SAMPLE_PAGES = 60
#: weight of a page written for training against one of the sample
WRITTEN_WEIGHT = 10.0
LABEL = "data-content"

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[a-z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
NEVER = frozenset("head script style title noscript template svg math iframe object canvas audio video select option button textarea xmp noembed noframes datalist".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark meta link q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
# starting one of these ends an open paragraph
ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
# starting the key ends an open element of the value, unless one of the barriers is nearer
ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "tbody": ("tbody", "thead", "tr", "td", "th"), "tfoot": ("tbody", "thead", "tr", "td", "th"), "option": ("option",), "body": ("head",),
}
BARRIERS = frozenset("ul ol dl table article section div body html aside nav main footer header form".split())

FRAMES = frozenset("nav footer header aside form".split())
KIND = {
    **{f"h{i}": "heading" for i in range(1, 7)}, "ul": "list", "ol": "list", "menu": "list", "li": "item", "dl": "list", "dt": "item", "dd": "item",
    "td": "cell", "th": "cell", "tr": "row", "table": "table", "pre": "quote", "blockquote": "quote", "figcaption": "quote",
}
# what class, id and role names say
NAMES = {
    "advert": "ad ads advert adverts advertisement sponsor sponsored promo promotion banner".split(),
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc tabs skip".split(),
    "side": "sidebar side aside widget related recommended more trending popular complementary".split(),
    "comment": "comment comments reply replies respond discussion disqus feedback reader readers".split(),
    "notice": "cookie cookies consent notice notices alert popup modal overlay gdpr paywall message dialog newsletter subscribe signup".split(),
    "frame": "footer header masthead topbar bottom copyright legal contentinfo".split(),
    "form": "form search login share social follow".split(),
    "body": "content article post entry story main text body".split(),
}
_NAMED = {word: kind for kind, words in NAMES.items() for word in words}


@dataclass
class Node:
    tag: str
    parent: int
    names: frozenset[str] = frozenset()
    label: int | None = None
    never: bool = False
    chars: int = 0
    linked: int = 0
    stops: int = 0


@dataclass
class Page:
    nodes: list[Node] = field(default_factory=list)
    #: (node, text) of the blocks in page order, white space already single
    blocks: list[tuple[int, str]] = field(default_factory=list)


def parse(source: str, labels: bool = False) -> Page:
    """Block elements as a tree, and the text of each block; inline elements belong to the block around them."""
    page = Page([Node("html", -1)])
    nodes = page.nodes
    stack: list[tuple[str, int]] = [("html", 0)]  # open elements; inline ones have their block's node
    held: list[str] = []
    links = 0

    def text(data: str) -> None:
        held.append(data)
        if links:
            nodes[stack[-1][1]].linked += len(data.strip())

    def flush() -> None:
        if held:
            found = " ".join(html.unescape("".join(held)).split())
            held.clear()
            if found:
                at = stack[-1][1]
                page.blocks.append((at, found))
                nodes[at].chars += len(found)
                nodes[at].stops += found.endswith((".", "!", "?", "…", ":", "\"", "”", "»"))

    def close(depth: int) -> None:
        nonlocal links
        if any(tag not in INLINE for tag, _ in stack[depth:]):
            flush()
        links -= sum(tag == "a" for tag, _ in stack[depth:])
        del stack[depth:]

    def opened(tags, barriers) -> int | None:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth][0] in tags:
                return depth
            if stack[depth][0] in barriers:
                return None
        return None

    at, end = 0, len(source)
    while at < end:
        start = source.find("<", at)
        if start < 0:
            text(source[at:])
            break
        if start > at:
            text(source[at:start])
        m = _TOKEN.match(source, start)
        if m is None:
            # a bare "<" is text
            text("&lt;")
            at = start + 1
            continue
        at = m.end()
        slash, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if tag is None:
            continue
        if not source.startswith(">", at - 1):
            break  # the page ends within a tag
        tag = tag.lower()
        if slash:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    close(depth)
                    break
                if tag in INLINE and stack[depth][0] not in INLINE:
                    break
            continue
        if tag in ("html", "br", "wbr", "hr") or tag in VOID:
            if tag == "br":
                held.append(" ")
            elif tag == "hr":
                flush()
            continue
        if tag in ENDS_P and (depth := opened(("p",), BARRIERS - {"form"} | {"td", "th", "li", "button"})) is not None:
            close(depth)
        if tag in ENDS:
            while (depth := opened(ENDS[tag], BARRIERS)) is not None:
                close(depth)
        if tag in INLINE:
            stack.append((tag, stack[-1][1]))
            links += tag == "a"
        else:
            flush()
            node = Node(tag, stack[-1][1], never=nodes[stack[-1][1]].never or tag in NEVER)
            for name, *values in _ATTRIBUTE.findall(attributes):
                name, value = name.lower(), "".join(values)
                if name in ("class", "id", "role"):
                    node.names |= {_NAMED[word] for word in _WORD.findall(value.lower()) if word in _NAMED}
                elif name in ("hidden", "aria-hidden") and value.lower() != "false":
                    node.never = True
                elif labels and name == LABEL:
                    node.label = int(value)
            nodes.append(node)
            stack.append((tag, len(nodes) - 1))
            if tag in RAW:
                ending = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.IGNORECASE).search(source, at)
                at = ending.start() if ending else end
    flush()
    return page


def features(page: Page) -> list[list[str]]:
    """What each node looks like: element, names, what it is in, length, links and sentence ends of all that is below."""
    nodes = page.nodes
    chars, linked, stops = ([getattr(n, what) for n in nodes] for what in ("chars", "linked", "stops"))
    for i in range(len(nodes) - 1, 0, -1):
        up = nodes[i].parent
        chars[up] += chars[i]
        linked[up] += linked[i]
        stops[up] += stops[i]
    found, inside = [], []
    for i, node in enumerate(nodes):
        share = min(1.0, linked[i] / chars[i]) if chars[i] else 0.0
        row = ["bias", "tag:" + KIND.get(node.tag, node.tag), f"links:{int(share * 3)}", f"length:{min(4, len(str(chars[i])) if chars[i] else 0)}"]
        row += ["name:" + name for name in node.names]
        above = node.parent
        inside.append(inside[above] | nodes[above].names - {"body"} | ({nodes[above].tag} & FRAMES) if above >= 0 else frozenset())
        row += ["in:" + name for name in inside[i]]
        row.append("stops" if stops[i] else "no stops")
        found.append(row)
    return found


def _odds(value: float) -> float:
    return math.exp(max(-40.0, min(40.0, value)))


def sum_product(parents: list[int], own: list[float], pair) -> tuple[list[float], list[float], list[float]]:
    """Exact inference on a tree whose nodes come after their parents.

    ``own`` are the nodes' log odds of 1, ``pair`` the potentials [parent][child]. Gives each node's marginal log
    odds, its log odds from itself and below, and the message that it sends to its parent.
    """
    (zz, zo), (oz, oo) = pair
    below, up = list(own), [0.0] * len(own)
    for i in range(len(own) - 1, 0, -1):
        odds = _odds(below[i])
        up[i] = math.log((oz + oo * odds) / (zz + zo * odds))
        below[parents[i]] += up[i]
    total = list(below)
    for i in range(1, len(own)):
        odds = _odds(total[parents[i]] - up[i])
        total[i] += math.log((zo + oo * odds) / (zz + oz * odds))
    return total, below, up


@dataclass(frozen=True)
class ContentModel:
    #: log odds that a feature adds to content
    weights: dict[str, float]
    #: pair potential by (parent, child)
    pair: tuple[tuple[float, float], tuple[float, float]]

    def marginals(self, page: Page) -> list[float]:
        """Log odds of content of every node."""
        get = self.weights.get
        own = [-40.0 if node.never else sum(get(name, 0.0) for name in row) for node, row in zip(page.nodes, features(page))]
        return sum_product([node.parent for node in page.nodes], own, self.pair)[0]

    def text(self, source: str) -> str:
        page = parse(source)
        odds = self.marginals(page)
        return "\n".join(text for at, text in page.blocks if odds[at] > 0 and not page.nodes[at].never)


def labelled(page: Page) -> list[int] | None:
    """A label per node, inherited from the nearest labelled one; None if no node is content."""
    labels: list[int] = []
    for node in page.nodes:
        above = labels[node.parent] if node.parent >= 0 else 0
        labels.append(0 if node.never else above if node.label is None else node.label)
    return labels if any(labels) else None


def by_markup(page: Page) -> None:
    """Label a page by its markup, if it has one article: that is content, except for what is named otherwise in it."""
    if sum(node.tag == "article" for node in page.nodes) != 1:
        return
    for node in page.nodes:
        if node.tag == "article":
            node.label = 1
        elif node.tag in ("nav", "footer", "aside", "form", "header") or node.names - {"body"}:
            node.label = 0


def train(pages: list[tuple[Page, float]], steps: int = 300, rate: float = 0.5, penalty: float = 0.02) -> ContentModel:
    """Potentials of greatest likelihood for labelled pages with weights, by gradient steps over exact marginals."""
    trees = []
    for page, weight in pages:
        labels = labelled(page)
        if labels is not None:
            trees.append((page, weight, labels, features(page)))
    names = sorted({name for _, _, _, rows in trees for row in rows for name in row})
    at = {name: i for i, name in enumerate(names)}
    parts = []
    for page, weight, labels, rows in trees:
        x = np.zeros((len(rows), len(names)))
        for i, row in enumerate(rows):
            x[i, [at[name] for name in row]] = 0.0 if page.nodes[i].never else 1.0
        parents = [node.parent for node in page.nodes]
        y = np.array(labels, dtype=float)
        joint = np.zeros((2, 2))
        np.add.at(joint, (y[parents[1:]].astype(int), y[1:].astype(int)), 1)
        parts.append((x, np.array([-40.0 if node.never else 0.0 for node in page.nodes]), parents, y, joint, weight))
    w, theta = np.zeros(len(names)), np.zeros((2, 2))
    seen_w, seen_t = np.full(len(names), 1e-6), np.full((2, 2), 1e-6)
    for _ in range(steps):
        slope_w, slope_t, pair = -penalty * w, -penalty * theta, np.exp(theta)
        for x, never, parents, y, joint, weight in parts:
            total, below, up = map(np.array, sum_product(parents, (x @ w + never).tolist(), pair.tolist()))
            p = 1 / (1 + np.exp(-np.clip(total, -40, 40)))
            slope_w = slope_w + weight * (y - p) @ x
            above = np.exp(np.clip(total[parents[1:]] - up[1:], -40, 40))
            child = np.exp(np.clip(below[1:], -40, 40))
            edges = np.array([pair[0, 0] + 0 * above, pair[0, 1] * child, pair[1, 0] * above, pair[1, 1] * above * child])
            slope_t = slope_t + weight * (joint - (edges / edges.sum(0)).sum(1).reshape(2, 2))
        seen_w, seen_t = seen_w + slope_w**2, seen_t + slope_t**2
        w, theta = w + rate * slope_w / np.sqrt(seen_w), theta + rate * slope_t / np.sqrt(seen_t)
    pair = np.exp(theta - theta.max())
    return ContentModel(dict(zip(names, w.tolist())), tuple(tuple(float(v) for v in row) for row in pair))


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample_pages: int = SAMPLE_PAGES) -> ContentModel:
    """Train from the pages written for it and a bounded sample of ``pages`` whose markup names an article."""
    from seasonlens.llm.labelled_pages import PAGES

    source = F.col(f"`{html_col}`").cast("string")
    rows = pages.select(F.xxhash64(F.col(f"`{id_col}`")).alias("order"), F.xxhash64(source).alias("key"), source.alias("html"))
    rows = rows.filter("html is not null")
    # the choice by hashes alone, then the pages: every task of an ordered limit sends its rows to the driver
    chosen = rows.select("order", "key").distinct().orderBy("order", "key").limit(sample_pages)
    sample = rows.join(F.broadcast(chosen), ["order", "key"]).dropDuplicates(["order", "key"]).orderBy("order", "key").collect()
    found = [(parse(source, labels=True), WRITTEN_WEIGHT) for source in PAGES]
    for row in sample:
        page = parse(row["html"])
        by_markup(page)
        found.append((page, 1.0))
    return train(found)


MADE = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])


def main_text(pages: DataFrame, model: ContentModel, keep: list[str], html_col: str = "html") -> DataFrame:
    """``keep`` columns, text and n_chars (code points) of every row of ``pages``.

    The text is what the model takes as content of the whole page: character references decoded, white space within
    a block one space, blocks in page order joined by a line feed; "" if there is none. A null page is an empty one.
    Elements that a page leaves open, and a page that ends within a tag, are closed; repeated rows give equal texts.
    ``keep`` must not hold a column named text or n_chars.
    """
    def start():
        def one(source: str) -> tuple[str, int]:
            text = model.text(source)
            return text, len(text)

        return one

    return with_columns(pages, html_col, MADE, start, keep)
