"""Main text of web pages by gradient-boosted trees over DOM nodes, with hierarchical decoding.

Every element and every text block of a page is a node with features: tag and parent's tag, words of class, id and role of
the node and above it, depth, place among its siblings, subtree sizes, text density, share of link text. Boosted trees
(Spark's) estimate whether main text lies in the node. Decoding then keeps the likeliest set of nodes in which every kept
node's parent is kept and every kept element has a kept child, so a block can never be kept inside a dropped subtree, nor a
subtree dropped around a kept block or kept without one.

There are no labelled pages, so training labels itself, on at most ``SAMPLE`` pages drawn by a hash: pages with an article
or main element give their nodes as they are; and each page's paragraphs are laid out again in ``LAYOUTS`` random pages
(containers with and without telling names, headers, menus, sidebars, adverts, notices, forms, comments, footers, made of
the page's own words; short, loud and repeated blocks among the paragraphs) of which the main text is known.

The text is the kept blocks in page order: character references decoded, white space inside a block turned into one blank,
blocks joined by an empty line. Nothing is cut.

Cases: null or empty html, or html without text, gives an empty text. Broken html is read as far as it goes, in one pass: a
script, style or comment without an end hides the rest, an svg, noscript, template, iframe, textarea or title without one hides nothing; a
quote opens a value only right after an equals sign and if it is closed, and a tag that does not close ends at the next ">". If no page of
the sample has a paragraph to learn from, all blocks outside scripts and styles are kept. Rows are read one by one,
repeated rows alike; other columns are not returned.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, stored
from tidemark.llm.dom import FEATURES, Page, features

SAMPLE, LAYOUTS = 250, 4
TREES, DEPTH = 20, 5
PARAGRAPH = 60
PAGES = 64
_OUTSIDE = frozenset("nav footer aside form header".split())


def _seeds(page: Page) -> np.ndarray:
    """Which blocks lie in an article or main element, outside of menus and the like; empty where there is no such."""
    inside = [0] * len(page.tag)
    for i in range(1, len(page.tag)):
        inside[i] = inside[page.parent[i]]
        if page.tag[i] in ("article", "main"):
            inside[i] = 1
        elif inside[i] and (page.tag[i] in _OUTSIDE or {"ad", "ads", "advert", "comments", "share", "related"} & set(page.names[i])):
            inside[i] = -1
    found = np.array([inside[owner] == 1 for owner, _, _ in page.blocks], dtype=bool)
    return found if found.any() else found[:0]


def _escaped(text: str) -> str:
    return text.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")


def layout(blocks: list[str], draw: np.random.Generator) -> tuple[str, set[str]]:
    """A random page around ``blocks``, and the texts of its main part."""
    words = " ".join(blocks).split() or ["x"]
    main = [" ".join(b.split()) for b in blocks]

    def pick(*choices: str) -> str:
        return choices[int(draw.integers(len(choices)))]

    def some(low: int, high: int) -> str:
        at = int(draw.integers(len(words)))
        text = " ".join((words[at:] + words)[: int(draw.integers(low, high))])
        return _escaped(text + pick(" »", " .", " |", " !"))

    def links(count: int) -> str:
        return "".join(f'<li><a href="/{i}">{some(1, 5)}</a></li>' for i in range(count))

    def box(names: tuple[str, ...], inner: str, *tags: str) -> str:
        if tags and draw.random() < 0.5:
            tag = pick(*tags)
            return f"<{tag}>{inner}</{tag}>"
        return f'<div {pick("class", "id")}="{pick(*names)}">{inner}</div>'

    def advert() -> str:
        return box(("ad", "ads", "advert", "ad-banner", "promo", "sponsored", "banner"), pick("", "<p>") + some(3, 30))

    def talk() -> str:
        rows = "".join(f'<{t} class="{pick("comment", "reply", "comment-body")}"><p>{some(5, 80)}</p></{t}>'
                       for t in [pick("div", "li", "article")] * int(draw.integers(1, 6)))
        return box(("comments", "discussion", "comment-list", "responses"), f"<h2>{some(1, 3)}</h2>{rows}", "section")

    parts = {
        "top": box(("header", "masthead", "top", "site-header"), pick("", "<h1>") + some(1, 6), "header"),
        "menu": box(("nav", "menu", "navbar", "breadcrumb"), f"<ul>{links(int(draw.integers(3, 9)))}</ul>", "nav"),
        "side": box(("sidebar", "related", "widget", "trending"), f"<h3>{some(1, 4)}</h3><ul>{links(4)}</ul><p>{some(4, 40)}</p>", "aside"),
        "notice": box(("notice", "cookie-notice", "alert", "consent", "newsletter", "popup"), f"<p>{some(4, 40)}</p><button>{some(1, 3)}</button>"),
        "form": box(("login", "search", "signup"), f'<form><label>{some(1, 4)}</label><input name="q"><button>{some(1, 2)}</button></form>'),
        "ad": advert(), "talk": talk(),
        "share": box(("share", "social", "share-buttons"), f"<ul>{links(3)}</ul>"),
        "foot": box(("footer", "site-footer", "copyright"), f"&copy; {some(2, 20)}", "footer"),
    }
    body = []
    # short headings and lists are main text too
    short = [f"{' '.join(t.split()[:int(draw.integers(1, 6))])} {i}" for i, t in enumerate(main)]
    for i, text in enumerate(main[:]):
        if draw.random() < 0.25:
            points = [f"{t} {j}" for j, t in enumerate(short[i:i + int(draw.integers(2, 6))])]
            kind = pick("ul", "ol", "h2", "h3")
            points = points[:1] if kind[0] == "h" else points
            body.append(f"<{kind}>{_escaped(points[0])}</{kind}>" if kind[0] == "h" else
                        f"<{kind}>{''.join(f'<li>{_escaped(p)}</li>' for p in points)}</{kind}>")
            main.extend(points)
        if i == 0:
            body.insert(0, f"<h1>{_escaped(short[0])}</h1>")
            main.append(short[0])
        tag = pick("p", "p", "p", "p", "p", "li", "blockquote", "h2", "pre", "td")
        inner = _escaped(text)
        if draw.random() < 0.3:
            inner = pick("<b>{}</b>", "<em>{}</em>", "<span>{}</span>", "<b>{}<br>").format(inner)
        closed = f"<{tag}>{inner}</{tag}>" if tag != "p" or draw.random() < 0.8 else f"<p>{inner}"
        body.append({"li": f"<ul>{closed}</ul>", "td": f"<table><tr>{closed}</tr></table>"}.get(tag, closed))
        if draw.random() < 0.2:
            # a cry, a line of figures, or a paragraph said again
            shout = pick(short[i].upper() + pick("!!", "!", "!!!", ""), short[i] + pick(":", " 100%!!", " ..."), text)
            tag = pick("p", "p", "p", "div", "li")
            body.append(f"<{tag}>{_escaped(shout)}</{tag}>")
            main.append(" ".join(shout.split()))
        if draw.random() < 0.06:
            body.append(parts[pick("ad", "share", "side", "notice", "form")])
    inner = "".join(body)
    if draw.random() < 0.3:
        inner += parts[pick("share", "talk", "ad", "side")]
    name = pick("content", "post", "entry-content", "article-body", "story", "main", "text", "wrap", "col-8", "x1")
    main_box = pick("<article>{}</article>", "<main>{}</main>", "<main><article>{}</article></main>",
                    f'<div class="{name}">{{}}</div>', f'<div id="{name}"><div>{{}}</div></div>',
                    f'<section class="{name}">{{}}</section>', "<div>{}</div>").format(inner)
    around = [k for k in parts if draw.random() < 0.6]
    first = [parts[k] for k in around if k in ("top", "menu", "notice", "form", "ad")]
    last = [parts[k] for k in around if k in ("side", "talk", "share", "foot")]
    page = "".join(first) + main_box + "".join(last)
    if draw.random() < 0.4:
        page = f'<div class="{pick("wrapper", "page", "container")}">{page}</div>'
    return f"<html><head><title>{some(1, 6)}</title></head><body>{page}</body></html>", set(main)


def _labelled(page: Page, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of all nodes: an element is kept with any block in it."""
    x, forest = features([page])
    y = np.zeros(len(x))
    y[len(page.tag):] = keep
    for here in forest.levels[:0:-1]:
        np.maximum.at(y, forest.parent[here], y[here])
    return x, y


def training_nodes(pages: DataFrame) -> DataFrame:
    """Labelled nodes of the sampled pages and of pages laid out from their paragraphs."""
    keyed = pages.select("html", F.xxhash64("page_id", "url", F.lit(4)).alias("draw")).filter(F.length("html") > 0)
    chosen = keyed.select("draw").distinct().orderBy("draw").limit(SAMPLE)

    def work(batch: pa.RecordBatch):
        for html, seed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            page, found = Page(html), []
            keep = _seeds(page)
            if len(keep):
                found.append(_labelled(page, keep))
                texts = [b[1] for b, k in zip(page.blocks, keep) if k]
            else:
                texts = [t for owner, t, link in page.blocks if page.tag[owner] == "p" and len(t) >= PARAGRAPH > link]
            draw = np.random.default_rng(seed & 0x7FFFFFFF)
            for _ in range(LAYOUTS if texts else 0):
                low = int(draw.integers(len(texts)))
                made, main = layout(texts[low:low + int(draw.integers(3, 25))], draw)
                again = Page(made)
                found.append(_labelled(again, np.array([b[1] in main for b in again.blocks], dtype=bool)))
            for x, y in found:
                lists = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), FEATURES).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([lists, pa.array(y)], ["x", "label"])

    return map_batches(keyed.join(F.broadcast(chosen), "draw").dropDuplicates(["draw"]).select("html", "draw"), work, "x array<double>, label double")


class Trees(NamedTuple):
    """Boosted trees as arrays, one row for each tree."""

    feature: np.ndarray  # -1 in a leaf
    value: np.ndarray    # threshold, or a leaf's prediction
    right: np.ndarray    # index of the right child; the left one is the next
    weight: np.ndarray

    def logit(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for feature, value, right, weight in zip(*self):
            at = np.zeros(len(x), dtype=np.int64)
            while True:
                asked = feature[at]
                inner = asked >= 0
                if not inner.any():
                    break
                left = x[rows, np.maximum(asked, 0)] <= value[at]
                at = np.where(inner, np.where(left, at + 1, right[at]), at)
            total += weight * value[at]
        return 2.0 * total


_SPLIT = re.compile(r"^( *)(?:If \(feature (\d+) <= ([^)]+)\)|Else \(feature|Predict: (\S+))")


def exported(model) -> Trees:
    """The model's trees as arrays, from their printed form (splits in preorder)."""
    rows = []
    for tree in model.trees:
        nodes, open_ = [], []
        for line in tree.toDebugString.splitlines():
            found = _SPLIT.match(line)
            if not found:
                continue
            if found[2] is not None:
                open_.append(len(nodes))
                nodes.append([int(found[2]), float(found[3]), 0])
            elif found[4] is not None:
                nodes.append([-1, float(found[4]), 0])
            else:
                nodes[open_.pop()][2] = len(nodes)
        rows.append(nodes)
    width = max(len(r) for r in rows)
    padded = np.array([r + [[-1, 0.0, 0]] * (width - len(r)) for r in rows])
    return Trees(padded[:, :, 0].astype(np.int64), padded[:, :, 1], padded[:, :, 2].astype(np.int64), np.array(model.treeWeights))


def fitted(pages: DataFrame) -> Trees | None:
    nodes = stored(training_nodes(pages), "html_nodes")
    if nodes.select("label").distinct().count() < 2:
        return None
    rows = nodes.select("label", array_to_vector("x").alias("features"))
    return exported(GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=4, minInstancesPerNode=5).fit(rows))


def extracted(pages: DataFrame, trees: Trees | None) -> DataFrame:
    """page_id, url and text of each page."""
    shared = pages.sparkSession.sparkContext.broadcast(trees)

    def work(batch: pa.RecordBatch):
        for low in range(0, batch.num_rows, PAGES):
            part = batch.slice(low, PAGES)
            read = [Page(h or "") for h in part.column(2).to_pylist()]
            x, forest = features(read)
            model = shared.value
            kept = forest.decode(model.logit(x) if model else np.ones(len(x)))
            texts = []
            for page, first in zip(read, forest.first):
                mine = kept[first + len(page.tag):]
                texts.append("\n\n".join(b[1] for b, k in zip(page.blocks, mine) if k))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    source = pages.select("page_id", "url", "html")
    kinds = dict(source.dtypes)
    return map_batches(source, work, f"page_id {kinds['page_id']}, url string, text string")


def op4_html(pages: DataFrame) -> DataFrame:
    return extracted(pages, fitted(pages)).withColumn("n_chars", F.length("text").cast("long"))
