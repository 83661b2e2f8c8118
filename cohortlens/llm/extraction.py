"""Main text of raw pages: boosted trees over DOM nodes, decoded along the tree.

Every element gets features of its subtree (text, links, density), its attribute tokens, its
depth and its siblings. Gradient-boosted trees give each the odds that it holds main text. The
most likely choice under the rule that a chosen element's ancestors are chosen too is found
exactly by one walk up and one walk down the tree, so no text is kept inside a rejected part.

No page tells which of its parts is main text, so the trees are trained on pages built from
blocks of text of the given table: articles with menus, headers, footers, sidebars, notices,
adverts, forms and comments around and inside them, in many markups, whose parts are known.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.llm import dom
from cohortlens.llm.common import map_rows
from cohortlens.sources.scratch import written

#: Pages whose blocks of text the training pages are built from, at most; chosen by hash.
FIT_PAGES = 200
#: Training pages built from each of them.
BUILT = 3
TREES = 20
DEPTH = 5
SEED = 5
#: Pages whose elements are scored together.
TOGETHER = 64

KEEP_TOKENS = frozenset(
    "article articlebody body blog content contents entry hentry main maincontent page post posts story text prose "
    "description single copy".split()
)
DROP_TOKENS = frozenset(
    "ad ads advert advertisement adverts adsense banner bar breadcrumb breadcrumbs byline caption comment comments "
    "consent contact cookie cookies copyright disclaimer disqus dropdown feedback foot footer form gdpr header hidden "
    "legal links login masthead menu menubar meta modal more nav navbar navigation newsletter notice overlay pager "
    "pagination popular popup privacy promo promoted promotion rail recommended register related replies reply respond "
    "search share sharing sidebar signup site skip skyscraper social sponsor sponsored subscribe tags teaser toolbar "
    "tooltip top topbar trending widget widgets".split()
)
TAG_GROUPS = (
    frozenset({"article", "main"}),
    frozenset({"section", "div", "center"}),
    frozenset({"p", "blockquote", "pre", "figcaption"}),
    frozenset({"h1", "h2", "h3", "h4", "h5", "h6", "hgroup"}),
    frozenset({"ul", "ol", "dl", "menu"}),
    frozenset({"li", "dd", "dt"}),
    frozenset({"nav"}),
    frozenset({"header"}),
    frozenset({"footer"}),
    frozenset({"aside"}),
    frozenset({"form", "fieldset", "label", "button", "input", "legend", "dialog", "search"}),
    frozenset({"table", "tbody", "thead", "tr", "td", "th"}),
    frozenset({"a"}),
    frozenset({"html", "body", "#page"}),
)
_GROUP = {tag: i for i, tags in enumerate(TAG_GROUPS) for tag in tags}
_BOILERPLATE_TAGS = frozenset({"nav", "header", "footer", "aside", "form", "dialog", "menu", "button", "label", "search"})
_CONTROLS = frozenset({"form", "input", "button", "select", "textarea", "label", "fieldset"})
_TOKENS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SENTENCE = re.compile(r"[.,;:!?]")


def tokens(attributes: dict[str, str]) -> set[str]:
    """Lower-case words of the class, id and role, camel case taken apart."""
    words = " ".join(attributes.get(name, "") for name in ("class", "id", "role"))
    return {w.lower() for w in _TOKENS.findall(words)}


N_OWN = 28
N_FEATURES = N_OWN + len(TAG_GROUPS)


def features(page: dom.Page) -> np.ndarray:
    """One row of features per element."""
    tag, parent = page.tag, page.parent
    count = len(tag)
    every = range(1, count)
    linked, para, bad_tag = [False] * count, [False] * count, [False] * count
    depth, good, bad, keep, drop = [0] * count, [0] * count, [0] * count, [0] * count, [0] * count
    for i in every:
        p = parent[i]
        name = tag[i]
        linked[i] = linked[p] or name == "a"
        para[i] = para[p] or name == "p"
        bad_tag[i] = bad_tag[p] or name in _BOILERPLATE_TAGS
        depth[i] = depth[p] + 1
        good[i], bad[i] = good[p], bad[p]
        if page.attributes[i]:
            words = tokens(page.attributes[i])
            keep[i], drop[i] = len(words & KEEP_TOKENS), len(words & DROP_TOKENS)
            good[i] += keep[i] > 0
            bad[i] += drop[i] > 0
    chars, marks, links, in_p, before = [0] * count, [0] * count, [0] * count, [0] * count, [0] * count
    seen = started = 0
    for element, _, text in page.text:
        size = len(" ".join(text.split()))
        if not size:
            continue
        if element > started:
            before[started + 1 : element + 1] = [seen] * (element - started)
            started = element
        seen += size
        chars[element] += size
        marks[element] += len(_SENTENCE.findall(text))
        if linked[element]:
            links[element] += size
        if para[element]:
            in_p[element] += size
    before[started + 1 :] = [seen] * (count - started - 1)
    own = np.array(chars, float)
    below, paragraphs, controls, anchors, many = [0] * count, [0] * count, [0] * count, [0] * count, [0] * count
    largest, ahead, behind, latest = [0] * count, [0] * count, [0] * count, [0] * count
    for i in range(count - 1, 0, -1):
        p = parent[i]
        name = tag[i]
        chars[p] += chars[i]
        marks[p] += marks[i]
        links[p] += links[i]
        in_p[p] += in_p[i]
        below[p] += below[i] + 1
        paragraphs[p] += paragraphs[i] + (name == "p")
        controls[p] += controls[i] + (name in _CONTROLS)
        anchors[p] += anchors[i] + (name == "a")
        # Siblings come last to first: ``latest`` is the one after this.
        many[p] += 1
        if chars[i] > largest[p]:
            largest[p] = chars[i]
        if latest[p]:
            behind[i] = chars[latest[p]]
            ahead[latest[p]] = chars[i]
        latest[p] = i
    up = np.array(parent)
    up[0] = 0
    size, starts = np.array(chars, float), np.array(before, float)
    most = np.maximum(size, 1.0)
    total = most[0]
    link_share = np.array(links) / most
    under = np.array(below)
    bads, goods = np.array(bad), np.array(good)
    out = np.zeros((count, N_FEATURES), np.float32)
    columns = (
        np.log1p(size),
        size / total,
        size / most[up],
        link_share,
        np.log1p(under),
        np.log1p(size / (under + 1)),
        np.log1p(paragraphs),
        np.array(in_p) / most,
        np.array(marks) / most,
        depth,
        np.arange(count) / count,
        starts / total,
        keep,
        drop,
        goods[up],
        bads[up],
        bad_tag,
        controls,
        np.log1p(anchors),
        np.log1p(own),
        ["hidden" in a for a in page.attributes],
        size[up] / total,
        link_share[up],
        (starts + size) / total,
        np.log1p(ahead),
        np.log1p(behind),
        np.log1p(np.array(many)[up]),
        size / np.maximum(np.array(largest)[up], 1),
    )
    for k, column in enumerate(columns):
        out[:, k] = column
    for i in every:
        if (group := _GROUP.get(tag[i])) is not None:
            out[i, N_OWN + group] = 1
    return out


def decode(parent: list[int], odds: np.ndarray) -> np.ndarray:
    """The most likely set of elements whose ancestors are all in it too.

    ``odds`` are log-odds of being main text. A subtree is worth its root's odds and its best
    children's worth, and is taken if that is above zero and its parent is taken.
    """
    worth = odds.astype(np.float64).copy()
    for i in range(len(parent) - 1, 0, -1):
        if worth[i] > 0:
            worth[parent[i]] += worth[i]
    kept = worth > 0
    for i in range(1, len(parent)):
        kept[i] &= kept[parent[i]]
    return kept


def assemble(page: dom.Page, kept: np.ndarray) -> str:
    """Kept text: white space in a block as one space, blocks apart by an empty line."""
    blocks: dict[int, list[str]] = {}
    for element, block, text in page.text:
        if kept[element]:
            blocks.setdefault(block, []).append(text)
    joined = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n\n".join(text for text in joined if text)


# --- the trees ------------------------------------------------------------------------


class Trees:
    """Boosted trees as arrays; scores all rows of a matrix together."""

    def __init__(self, trees: list[tuple[np.ndarray, ...]], weights: list[float]) -> None:
        self.trees, self.weights = trees, weights

    @classmethod
    def of(cls, model: object) -> Trees:
        """From a fitted Spark model, by the printed form of its trees."""
        return cls([_parse(tree.toDebugString) for tree in model.trees], list(model.treeWeights))

    def odds(self, rows: np.ndarray) -> np.ndarray:
        margin = np.zeros(len(rows))
        every = np.arange(len(rows))
        for (feature, threshold, low, high, value), weight in zip(self.trees, self.weights, strict=True):
            node = np.zeros(len(rows), np.int32)
            for _ in range(DEPTH):
                f = feature[node]
                left = rows[every, f] <= threshold[node]
                node = np.where(f < 0, node, np.where(left, low[node], high[node]))
            margin += weight * value[node]
        return 2 * margin


def _parse(printed: str) -> tuple[np.ndarray, ...]:
    lines = [line.strip() for line in printed.splitlines() if line.strip().startswith(("If", "Else", "Predict"))]
    nodes: list[list[float]] = []

    def build(at: int) -> tuple[int, int]:
        number = len(nodes)
        if lines[at].startswith("Predict"):
            nodes.append([-1, 0, 0, 0, float(lines[at].split(":")[1])])
            return number, at + 1
        test = re.match(r"If \(feature (\d+) <= ([^)]+)\)", lines[at])
        nodes.append([int(test[1]), float(test[2]), 0, 0, 0.0])
        nodes[number][2], at = build(at + 1)
        nodes[number][3], at = build(at + 1)  # the line of its Else
        return number, at

    build(0)
    table = np.array(nodes)
    return table[:, 0].astype(np.int32), table[:, 1], table[:, 2].astype(np.int32), table[:, 3].astype(np.int32), table[:, 4]


# --- training pages -------------------------------------------------------------------


def pieces(source: str) -> tuple[list[str], list[str]]:
    """Long and short blocks of text of a page, as raw material."""
    page = dom.read(source)
    texts = assemble(page, np.ones(len(page.tag), bool)).split("\n\n")
    return [t for t in texts if len(t) >= 80], [t for t in texts if 0 < len(t) < 80]


def build(long: list[str], short: list[str], chance: random.Random) -> str:
    """A page of known parts: what stands in ``data-part="1"`` but not in an inner ``"0"`` is main text."""
    esc = lambda t: t.replace("&", "&amp;").replace("<", "&lt;")
    pick = chance.choice
    few = lambda a, b: range(chance.randint(a, b))
    brief = lambda: esc(pick(short) if short else " ".join(pick(long).split()[:6]))
    prose = lambda: esc(pick(long))
    some = lambda: esc(" ".join(pick(long).split()[: chance.randint(5, 40)]))
    semantic = chance.random() < 0.5
    plain = chance.random() < 0.25

    def part(tag: str, names: str, inner: str, mark: str = "0") -> str:
        """Semantic pages use the tag, others a div; both may carry a telling class or id."""
        name = pick(names.split())
        shown = f' {pick(["class", "id"])}="{name}"' if not (plain and semantic) and (not semantic or chance.random() < 0.6) else ""
        tag = tag if semantic else "div"
        return f'<{tag}{shown} data-part="{mark}">{inner}</{tag}>'

    def links(low: int, high: int) -> str:
        body = "".join(f'<li><a href="/{i}">{brief()}</a></li>' for i in few(low, high))
        return f"<ul>{body}</ul>" if chance.random() < 0.8 else " | ".join(f'<a href="/{i}">{brief()}</a>' for i in few(low, high))

    def boiler(kind: str) -> str:
        if kind == "nav":
            return part("nav", "nav menu navbar main-nav site-nav topmenu breadcrumbs navigation", links(3, 9))
        if kind == "header":
            inner = f"<a href='/'>{brief()}</a>" + (f"<p>{some()}</p>" if chance.random() < 0.5 else "")
            return part("header", "header site-header masthead top-bar banner", inner)
        if kind == "footer":
            inner = f"&copy; {brief()} &middot; {some()}" if chance.random() < 0.6 else f"<p>&copy; {some()}</p>{links(2, 5)}"
            return part("footer", "footer site-footer foot page-footer copyright", inner)
        if kind == "aside":
            inner = f"<h3>{brief()}</h3>" + (links(3, 7) if chance.random() < 0.5 else "".join(f"<p>{some()}</p>" for _ in few(1, 4)))
            return part("aside", "sidebar widget related popular right-rail recommended trending side-bar", inner)
        if kind == "ad":
            name = pick("ad ads advert advertisement sponsored promo ad-slot banner-ad".split())
            inner = pick((some(), f"<p>{some()}</p>", f"<a href='/x'>{some()}</a>"))
            return f'<{(t := pick(["div", "div", "aside", "section"]))} class="{name}" data-part="0">{inner}</{t}>'
        if kind == "notice":
            inner = pick((some(), f"<p>{some()}</p><button>{brief()}</button>"))
            return f'<div {pick(["class", "id"])}="{pick("cookie-notice notice cookie-banner consent gdpr alert-notice privacy-notice disclaimer".split())}" data-part="0">{inner}</div>'
        if kind == "form":
            inner = f"<p>{some()}</p><label>{brief()}</label><input type='text'><button>{brief()}</button>"
            return f'<form class="{pick("newsletter signup search-form login subscribe contact".split())}" data-part="0">{inner}</form>'
        if kind == "share":
            return f'<div class="{pick("share social tags byline meta".split())}" data-part="0">{links(2, 4)}</div>'
        each = lambda: f'<{(t := pick(["div", "li", "article"]))} class="{pick(["comment", "comment-body", "reply"])}"><b>{brief()}</b><p>{pick((prose, some))()}</p></{t}>'
        tag = pick(["section", "div", "div"])
        title = f"<h3>{brief()}</h3>" if chance.random() < 0.5 else ""
        return f'<{tag} {pick(["class", "id"])}="{pick("comments comment-list discussion-comments respond user-comments reader-comments replies".split())}" data-part="0">{title}{"".join(each() for _ in few(1, 5))}</{tag}>'

    def marked(text: str) -> str:
        """Prose with links, emphasis, spans and code around runs of its words, one inside another at times."""
        words, out = text.split(), []
        rate = pick((0, 0.01, 0.03, 0.08, 0.2))
        while words:
            if chance.random() >= rate:
                out.append(words.pop(0))
                continue
            run = chance.randint(1, pick((2, 5, 12)))
            inner, words = " ".join(words[:run]), words[run:]
            for tag in chance.sample(("a", "a", "a", "em", "strong", "b", "i", "span", "code"), 1 + (chance.random() < 0.15)):
                inner = f"<{tag} href='/x'>{inner}</a>" if tag == "a" else f"<{tag}>{inner}</{tag}>"
            out.append(inner)
        return " ".join(out)

    def listed() -> str:
        """An item of a list in the body, at times only a link or led by one."""
        kind = chance.random()
        if kind < 0.3:
            return f"<a href='/x'>{pick((brief, some))()}</a>"
        return f"<a href='/x'>{brief()}</a> {some()}" if kind < 0.5 else marked(some())

    def body_block() -> str:
        roll = chance.random()
        if roll < 0.66:
            return f"<p>{marked(prose())}</p>"
        if roll < 0.70:
            return f"<pre>{some()}</pre>" if chance.random() < 0.5 else f"<pre><code>{some()}</code></pre>"
        if roll < 0.72:
            return f"<p><a href='/x'>{some()}</a></p>"
        if roll < 0.78:
            return f"<p><b>{some()}.<br><p>{marked(prose())}</p>"
        if roll < 0.82:
            return f"<h2>{brief()}</h2><p>{marked(prose())}"
        if roll < 0.88:
            return f"<{(t := pick(['ul', 'ol']))}>" + "".join(f"<li>{listed()}</li>" for _ in few(2, 5)) + f"</{t}>"
        if roll < 0.92:
            return f"<blockquote>{marked(some())}</blockquote>"
        if roll < 0.95:
            return f"<figure><img src='a.png'><figcaption>{brief()}</figcaption></figure>"
        if roll < 0.97:
            return f"<table><tr><td>{brief()}</td><td>{some()}</td></tr></table>"
        return f"<div>{marked(prose())}</div>"

    title = f"<h1>{brief()}</h1>"
    inner = [body_block() for _ in few(1, 14)] if chance.random() < 0.9 else [f"<p>{some()}</p>"]
    for kind in ("ad", "share", "aside", "form", "comments", "notice", "header", "footer", "nav"):
        if chance.random() < (0.25 if kind in ("ad", "share", "comments") else 0.06):
            inner.insert(chance.randint(0, len(inner)) if kind != "comments" else len(inner), boiler(kind))
    names = "content post entry article-body story main-content post-content entry-content articleBody article text"
    inside = title + "".join(inner) if chance.random() < 0.85 else "".join(inner)
    article = part(pick(["article", "article", "main", "section"]), names, inside, "1")
    if inside is not title and title not in article:
        article = title.replace("<h1", '<h1 data-part="1"') + article
    if chance.random() < 0.35:
        article = f'<{pick(["main", "div"])} {pick(["class", "id"])}="{pick("main wrapper container page-body".split())}" data-part="x">{article}'
    ahead = [boiler(k) for k in ("notice", "header", "nav", "ad", "aside", "form") if chance.random() < 0.45]
    after = [boiler(k) for k in ("share", "comments", "aside", "ad", "form", "nav", "notice") if chance.random() < 0.3]
    if chance.random() < 0.8:
        after.append(boiler("footer"))
    chance.shuffle(ahead)
    return f"<!DOCTYPE html><html><head><title>{brief()}</title></head><body>{''.join(ahead)}{article}{''.join(after)}</body></html>"


def truth(page: dom.Page) -> np.ndarray:
    """1 for elements that hold main text of a built page, themselves or below."""
    inside = [False] * len(page.tag)
    for i in range(1, len(page.tag)):
        mark = page.attributes[i].get("data-part")
        inside[i] = inside[page.parent[i]] if mark not in ("0", "1") else mark == "1"
    label = np.zeros(len(page.tag), np.int8)
    for element, _, text in page.text:
        if text.strip() and inside[element]:
            label[element] = 1
    for i in range(len(page.tag) - 1, 0, -1):
        if label[i]:
            label[page.parent[i]] = 1
    return label


def training_nodes(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """Features and labels of the elements of built pages; at most FIT_PAGES pages are read for it."""
    chosen = (
        pages.filter(F.length(html_col) > 200)
        .select(F.col(id_col).cast("long").alias("id"), F.col(html_col).alias("html"))
        .select(F.xxhash64("id", "html").alias("draw"), "html")
        .orderBy("draw")
        .limit(FIT_PAGES)
        .repartition(8, "draw")
        .sortWithinPartitions("draw")
    )

    def make(rows: Iterable[tuple]) -> Iterator[tuple]:
        for draw, source in rows:
            long, short = pieces(source)
            if not long:
                continue
            chance = random.Random(f"{SEED}:{draw}")
            for _ in range(BUILT):
                page = dom.read(build(long, short, chance))
                for row, label in zip(features(page).tolist(), truth(page).tolist(), strict=True):
                    yield row, float(label)

    schema = T.StructType([T.StructField("row", T.ArrayType(T.FloatType())), T.StructField("label", T.DoubleType())])
    return written(map_rows(chosen, make, schema), "nodes")


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> Trees | None:
    """Trees trained on pages built from the table's text; None if it has no text to build from."""
    nodes = training_nodes(pages, id_col, html_col)
    if nodes.select("label").distinct().count() < 2:
        return None
    examples = nodes.select(array_to_vector(F.col("row").cast("array<double>")).alias("features"), "label").cache()
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=SEED, cacheNodeIds=False).fit(examples)
    examples.unpersist()
    return Trees.of(model)


def main_text(source: str, odds: np.ndarray, page: dom.Page) -> str:
    return assemble(page, decode(page.parent, np.clip(odds, -4, 4)))


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row ``(page_id, url, text, n_chars)`` per row of ``pages``; no shuffle.

    A null or empty page, and one without main text, has an empty text. Markup that is broken
    is read as far as it goes. Null ids and urls stay null; equal rows give equal rows. Other
    columns are not read; an empty table gives an empty table. Should no page of the table hold
    a block of 80 characters to train with, all seen text is kept.
    """
    trees = fit(pages, id_col, html_col)

    def make(rows: Iterable[tuple]) -> Iterator[tuple]:
        rows = iter(rows)
        while group := list(islice(rows, TOGETHER)):
            read = [dom.read(source or "") for *_, source in group]
            found = [features(page) for page in read]
            odds = trees.odds(np.concatenate(found)) if trees else np.ones(sum(map(len, found)))
            at = 0
            for (key, url, source), page in zip(group, read, strict=True):
                text = main_text(source, odds[at : at + len(page.tag)], page)
                at += len(page.tag)
                yield key, url, text, len(text)

    schema = T.StructType(
        [
            T.StructField("page_id", T.LongType()),
            T.StructField("url", T.StringType()),
            T.StructField("text", T.StringType()),
            T.StructField("n_chars", T.LongType()),
        ]
    )
    return map_rows(pages.select(F.col(id_col).cast("long"), F.col(url_col), F.col(html_col)), make, schema)
