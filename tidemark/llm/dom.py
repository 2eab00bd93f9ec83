"""A small tolerant reader of web pages: elements, text blocks and features of both."""

from __future__ import annotations

import re
from html import unescape

import numpy as np

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg".split())
# raw elements whose missing end hides nothing: only the tag is skipped
OPEN = frozenset("svg noscript template iframe textarea title".split())
BLOCK = frozenset(
    "html body article main section div nav header footer aside form p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody "
    "tfoot tr td th blockquote pre figure figcaption address fieldset details summary hr center option select button label".split())
# an opening tag on the left ends an open element on the right
ENDS = {**{t: frozenset("p") for t in BLOCK}, "li": frozenset(("li", "p")), "dt": frozenset(("dt", "dd", "p")),
        "dd": frozenset(("dt", "dd", "p")), "tr": frozenset(("tr", "td", "th", "p")), "td": frozenset(("td", "th", "p")),
        "th": frozenset(("td", "th", "p")), "option": frozenset(("option",))}
# implied ends do not reach beyond these
FENCE = frozenset("html body article main section div nav header footer aside form ul ol dl table blockquote".split())
TAGS = ("article main section div nav header footer aside form p h li table quote inline other").split()
_GROUP = {**{t: t for t in TAGS}, **{f"h{i}": "h" for i in range(1, 7)}, "ul": "li", "ol": "li", "dl": "li", "dt": "li", "dd": "li",
          **{t: "table" for t in "thead tbody tr td th".split()}, "blockquote": "quote", "pre": "quote", "figcaption": "quote",
          **{t: "inline" for t in "a b i em strong span u small code sub sup abbr time cite mark label".split()},
          **{t: "form" for t in "button select option fieldset".split()}}
# words of class, id and role, by what they usually name
WORDS = {
    "content": "article content post entry story main body text blog news page copy prose document".split(),
    "menu": "nav navigation navbar menu breadcrumb breadcrumbs pagination pager tabs toolbar skip toc".split(),
    "frame": "header masthead footer foot copyright top bottom logo site brand legal".split(),
    "side": "sidebar aside side widget related recommended more popular trending tags rail teaser".split(),
    "advert": "ad ads advert advertisement advertising banner promo promotion promoted sponsor sponsored commercial".split(),
    "notice": "notice cookie cookies consent gdpr alert warning popup modal overlay message subscribe newsletter paywall".split(),
    "talk": "comment comments reply replies discussion disqus respond feedback reviews thread share sharing social".split(),
    "form": "form search login signin signup input contact".split(),
}
_WORD_GROUP = {w: g for g, words in WORDS.items() for w in words}
_NAMED = re.compile(r"""(?:^|\s)(?:class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_SPLIT = re.compile(r"[^a-z]+")
# A quote opens a value only right after an equals sign, and only if it is closed; else the tag ends at the next ">". The
# parts are possessive, so nothing is read twice.
_VALUES = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+"""
_TOKEN = re.compile(
    rf"""<(?:!--.*?(?:-->|\Z)|[!?][^>]*+(?:>|\Z)|(/?)([A-Za-z][^\s/>]*+)(?:({_VALUES})>|([^>]*+)>))""", re.S)
# one that is never closed hides the rest
_COMMENT = re.compile(r"<[!?]")
_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I | re.A) for t in RAW}
_PAIRED = {t: re.compile(rf"""<(/?){t}(?=[\s/>])(?:({_VALUES})>|([^>]*+)>)""", re.I | re.A) for t in OPEN}


def raw_ends(html: str, tag: str) -> dict[int, int]:
    """Where each element ``tag`` that has an end begins, and the place behind its end."""
    begun: list[int] = []
    ends: dict[int, int] = {}
    for found in _PAIRED[tag].finditer(html, 0, html.rfind(">") + 1):
        if not found[1]:
            if not _closed(tag, found[2] or found[3] or ""):
                begun.append(found.start())
        elif begun:
            ends[begun.pop()] = found.end()
    return ends


def _closed(tag: str, attributes: str) -> bool:
    return tag == "svg" and attributes.endswith("/")


class Page:
    """Elements in page order (parents first) and text blocks with the element that holds them."""

    def __init__(self, html: str):
        self.tag: list[str] = ["#root"]
        self.parent: list[int] = [-1]
        self.names: list[tuple[str, ...]] = [()]
        self.blocks: list[tuple[int, str, int]] = []  # element, text, characters inside links
        self._stack = [0]
        self._parts: list[str] = []
        self._link = 0
        self._owner = 0
        self._read(html)

    def _flush(self) -> None:
        if self._parts:
            text = " ".join(unescape("".join(self._parts)).split())
            if text:
                self.blocks.append((self._owner, text, min(self._link, len(text))))
        self._parts, self._link = [], 0

    def _text(self, raw: str) -> None:
        if not raw:
            return
        if not self._parts:
            if raw.isspace():
                return
            # a block belongs to the nearest block element
            at = self._stack[-1]
            while at and self.tag[at] not in BLOCK:
                at = self.parent[at]
            self._owner = at
        self._parts.append(raw)
        if any(self.tag[i] == "a" for i in self._stack[-4:]):
            self._link += len(raw.strip())

    def _open(self, tag: str, attributes: str) -> None:
        if tag in BLOCK:
            self._flush()
            ends = ENDS[tag]
            at = len(self._stack) - 1
            cut = None
            while at > 0 and not (self.tag[self._stack[at]] in FENCE):
                if self.tag[self._stack[at]] in ends:
                    cut = at
                at -= 1
            if cut is not None:
                del self._stack[cut:]
        if tag in VOID:
            if tag == "br" and self._parts:
                self._parts.append(" ")
            return
        found: tuple[str, ...] = ()
        if attributes and "=" in attributes:
            named = " ".join(a or b or c for a, b, c in _NAMED.findall(attributes))
            found = tuple(w for w in _SPLIT.split(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", named).lower()) if w)
        self.tag.append(tag)
        self.parent.append(self._stack[-1])
        self.names.append(found)
        if not attributes.endswith("/") or tag in BLOCK:
            self._stack.append(len(self.tag) - 1)

    def _close(self, tag: str) -> None:
        if tag in BLOCK:
            self._flush()
        for at in range(len(self._stack) - 1, 0, -1):
            if self.tag[self._stack[at]] == tag:
                del self._stack[at:]
                return
            if tag not in BLOCK and self.tag[self._stack[at]] in BLOCK:
                return  # an inline end tag does not close blocks

    def _read(self, html: str) -> None:
        at, ends = 0, {}
        # behind the last ">" no tag can close, so none is looked for
        last = html.rfind(">") + 1
        while True:
            found = _TOKEN.search(html, at, last) or _COMMENT.search(html, max(at, last))
            if not found:
                self._text(html[at:])
                break
            self._text(html[at:found.start()])
            if found.re is _COMMENT:
                break
            at, tag = found.end(), (found[2] or "").lower()
            if not tag:
                continue
            attributes = found[3] or found[4] or ""
            if found[1]:
                self._close(tag)
            elif tag in OPEN:
                if not _closed(tag, attributes):
                    if tag not in ends:
                        ends[tag] = raw_ends(html, tag)
                    at = ends[tag].get(found.start(), at)
            elif tag in RAW:
                end = _END[tag].search(html, at)
                at = html.find(">", end.end()) + 1 if end else 0
                if not at:
                    break
            else:
                self._open(tag, attributes)
        self._flush()


_COLUMNS = (
    *(f"tag_{t}" for t in TAGS), *(f"up_{t}" for t in TAGS), *(f"own_{g}" for g in WORDS), *(f"above_{g}" for g in WORDS),
    "above_nav", "above_article", "leaf", "depth", "chars", "tags", "density", "links", "paragraphs", "blocks", "mean_block",
    "stops", "place", "of_siblings", "siblings", "same_siblings", "share", "sibling_chars", "title")
FEATURES = len(_COLUMNS)
_AT = {name: i for i, name in enumerate(_COLUMNS)}


_GROUPS = {g: i for i, g in enumerate(TAGS)}
_PLACES = {g: i for i, g in enumerate(WORDS)}
_AROUND = np.array([g in ("nav", "footer", "aside", "form") for g in TAGS])
_INSIDE = np.array([g in ("article", "main") for g in TAGS])


class Forest:
    """The nodes of several pages: of each its elements, then its blocks. ``parent`` of a root is -1."""

    def __init__(self, pages: list[Page]):
        self.elements = np.array([len(p.tag) for p in pages])
        self.blocks = np.array([len(p.blocks) for p in pages])
        self.first = np.concatenate(([0], np.cumsum(self.elements + self.blocks)))
        self.page = np.repeat(np.arange(len(pages)), np.diff(self.first))
        local = np.arange(self.first[-1]) - self.first[self.page]
        self.leaf = local >= self.elements[self.page]
        parent = np.array([up for p in pages for up in (*p.parent, *(b[0] for b in p.blocks))], dtype=np.int64)
        self.parent = np.where(parent < 0, -1, parent + self.first[self.page])
        self.has = self.parent >= 0
        self.up = np.maximum(self.parent, 0)
        depth = np.zeros(len(parent), dtype=np.int64)
        self.levels = [np.flatnonzero(~self.has)]
        # blocks come last, so elements alone make the levels above them
        inner, below = np.flatnonzero(self.has), np.ones(len(parent), dtype=bool)
        below[self.has] = False
        while len(inner):
            mine = below[self.parent[inner]]
            here = inner[mine]
            depth[here] = len(self.levels)
            self.levels.append(here)
            inner, below[here] = inner[~mine], True
        self.depth = depth

    def decode(self, logit: np.ndarray) -> np.ndarray:
        """Which nodes are kept: of all choices in which a kept node's parent is kept and a kept element has a kept child,
        the likeliest; an element without text below is never kept."""
        best, gain = np.array(logit, dtype=float), np.zeros(len(logit))
        top = np.full(len(logit), -np.inf)
        for here in self.levels[::-1]:
            inner = here[~self.leaf[here]]
            best[inner] += np.where(top[inner] > 0, gain[inner], top[inner])
            above = here[self.has[here]]
            np.maximum.at(top, self.parent[above], best[above])
            gaining = above[best[above] > 0]
            np.add.at(gain, self.parent[gaining], best[gaining])
        kept = best > 0
        for here in self.levels[1:]:
            up = self.parent[here]
            # the only child of a kept element that is kept although it lowers the sum
            forced = here[(top[up] <= 0) & (best[here] == top[up])]
            _, first = np.unique(self.parent[forced], return_index=True)
            kept[forced[first]] = True
            kept[here] &= kept[up]
        return kept


def features(pages: list[Page]) -> tuple[np.ndarray, Forest]:
    """Features of all nodes of the pages."""
    forest = Forest(pages)
    up, has, leaf, total = forest.up, forest.has, forest.leaf, len(forest.parent)
    tags = [t for p in pages for t in (*p.tag, *([None] * len(p.blocks)))]
    group = np.array([_GROUPS["inline"] if t is None else _GROUPS[_GROUP.get(t, "other")] for t in tags])
    of_block = [(len(text), link, text.count(".") + text.count("!") + text.count("?") + text.count(","))
                for p in pages for _, text, link in p.blocks]
    # characters, characters in links, stops, tags, paragraphs and blocks of a node and all below it
    sums = np.zeros((total, 6))
    sums[leaf, :3] = np.array(of_block).reshape(-1, 3)
    sums[leaf, 5] = 1
    sums[~leaf & has, 3] = 1
    sums[:, 4] = np.array([t == "p" for t in tags]) & has
    size = sums[leaf, 0]
    number = np.cumsum(leaf) - 1
    before = np.concatenate(([0], np.cumsum(size)))
    start = np.concatenate(([0], np.cumsum(forest.blocks)))
    first_block = np.where(leaf, number, start[forest.page + 1])
    for here in forest.levels[:0:-1]:
        np.add.at(sums, up[here], sums[here])
        np.minimum.at(first_block, up[here], first_block[here])
    chars, links, stops, inner_tags, paragraphs, blocks = sums.T
    own = np.zeros((total, len(WORDS)))
    for p, low in zip(pages, forest.first):
        for i, names in enumerate(p.names):
            for word in names:
                at = _WORD_GROUP.get(word)
                if at:
                    own[low + i, _PLACES[at]] += 1
    above = np.zeros((total, len(WORDS) + 2))
    told = np.column_stack((own, _AROUND[group], _INSIDE[group]))
    for here in forest.levels[1:]:
        above[here] = np.maximum(above[up[here]], told[up[here]])
    # place among the children of a parent, elements before blocks
    order = np.argsort(up + ~has * total * 2, kind="stable")
    kin = up[order]
    place = np.empty(total)
    place[order] = np.arange(total) - np.searchsorted(np.where(has[order], kin, 2 * total), np.where(has[order], kin, 2 * total))
    children = np.bincount(up[has], minlength=total)
    kind = up * (len(TAGS) + 1) + np.where(leaf, len(TAGS), group)
    _, alike, count = np.unique(np.where(has, kind, -1), return_inverse=True, return_counts=True)
    all_chars = np.maximum(before[start[1:]] - before[start[:-1]], 1)[forest.page]
    x = np.zeros((total, FEATURES))
    rows = np.arange(total)
    x[rows, _AT["tag_" + TAGS[0]] + group] = 1
    x[rows[has], _AT["up_" + TAGS[0]] + group[up[has]]] = 1
    x[:, _AT["own_content"]:_AT["own_content"] + len(WORDS)] = own
    x[:, _AT["above_content"]:_AT["above_content"] + len(WORDS) + 2] = above
    brothers = children[up]
    columns = {
        "leaf": leaf, "of_siblings": np.where(has, place / np.maximum(brothers, 1), 0), "siblings": np.where(has, np.minimum(brothers, 50), 0),
        "same_siblings": np.where(has, count[alike] / np.maximum(brothers, 1), 0),
        "sibling_chars": np.where(has, np.log1p((chars[up] - chars) * has / np.maximum(brothers - 1, 1)), 0),
        "depth": np.minimum(forest.depth, 40), "chars": np.log1p(chars), "tags": np.log1p(inner_tags),
        "density": np.log1p(chars / np.maximum(inner_tags, 1)), "links": links / np.maximum(chars, 1), "paragraphs": np.log1p(paragraphs),
        "blocks": np.log1p(blocks), "mean_block": np.log1p(chars / np.maximum(blocks, 1)),
        "stops": np.minimum(stops / np.maximum(chars, 1) * 50, 5),
        "place": (before[first_block] - before[start[forest.page]]) / all_chars, "share": chars / all_chars,
        "title": np.array([t == "h1" for t in tags])}
    for name, values in columns.items():
        x[:, _AT[name]] = values
    return x, forest
