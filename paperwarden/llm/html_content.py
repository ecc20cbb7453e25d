"""Main text of web pages by a tree-structured graphical model.

Every element and every text of a page is a node that is main text or not. Node potentials weigh what is seen of a
node (tag, words of class, id and role, amount of text, links and punctuation); edge potentials couple each node with
its parent, by the kind of the child. Sum-product messages go up from the leaves and down from the root, level by
level, and give each node's exact marginal. The weights maximise the likelihood of labelled pages: their gradient is
the difference between the labels and the marginals of nodes and of parent-child pairs. Texts with a marginal above
one half are the main text.

A batch of pages is one forest of arrays, so messages of all pages pass together. Every page is handled whole.

Defined cases: null and empty pages, and pages without main text, give an empty text; broken and cut-off markup is
mended; repeated rows and null ids are rows like others; a node
whose two marginals are equal is no content; an empty table gives an empty result. Columns beyond the named ones are
ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from paperwarden.llm.html_tree import INLINE, Tree, blocks, parse
from paperwarden.llm.labelled_pages import labelled_pages

FEATURES = 4_096
#: Kinds of children with edge potentials of their own.
KINDS = ("text", "inline", "paragraph", "heading", "list", "other", "frame")
FRAMES = frozenset("nav header footer aside form section article main body html".split())
STEPS = 250
#: Texts handled together, in characters of markup.
FOREST_CHARS = 2_000_000

_NAME = re.compile(r"[a-z]+")


def _kind(tag: str) -> int:
    if tag == "text":
        return 0
    if tag in INLINE or tag == "br":
        return 1
    if tag in ("p", "blockquote", "pre", "figure", "figcaption"):
        return 2
    if re.fullmatch(r"h[1-6]", tag):
        return 3
    if tag in ("ul", "ol", "li", "dl", "dt", "dd", "table", "tbody", "tr", "td", "th"):
        return 4
    return 6 if tag in FRAMES else 5


def _bucket(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) % FEATURES


def _level(n: float) -> int:
    return int(n).bit_length()


def node_features(tree: Tree) -> list[list[int]]:
    """What is seen of every node."""
    size = len(tree.tag)
    chars, linked, stops = [0] * size, [0] * size, [0] * size
    in_link = [False] * size
    for node in range(1, size):
        in_link[node] = tree.tag[node] == "a" or in_link[tree.parent[node]]
        if tree.tag[node] == "text":
            said = tree.text[node].strip()
            chars[node] = len(said)
            linked[node] = len(said) if in_link[node] else 0
            stops[node] = said.count(". ") + said.count(", ") + said.endswith((".", "!", "?"))
    for node in range(size - 1, 0, -1):
        parent = tree.parent[node]
        chars[parent] += chars[node]
        linked[parent] += linked[node]
        stops[parent] += stops[node]
    found = []
    for node in range(size):
        tag = tree.tag[node]
        own = "text" if tag == "text" else "element"
        share = 4 * linked[node] // chars[node] if chars[node] else 5
        names = [f"tag {tag}", f"{own} chars {_level(chars[node])}", f"{own} links {share}",
                 f"{own} stops {_level(stops[node])}", f"kind {_kind(tag)} links {share}"]
        if tag == "text":
            names.append(f"in {tree.tag[tree.parent[node]]}")
        else:
            for key in ("class", "id", "role"):
                given = tree.attributes[node].get(key, "").lower()
                names += [f"named {word.removesuffix('s')}" for word in _NAME.findall(given)]
        found.append([_bucket(n) for n in names])
    return found


@dataclass
class Forest:
    """Several trees as arrays; roots have parent -1."""

    parent: np.ndarray
    kind: np.ndarray
    levels: list[np.ndarray]
    owner: np.ndarray
    feature: np.ndarray

    @classmethod
    def of(cls, trees: list[Tree]) -> Forest:
        parent, depth, kind, owner, feature, base = [], [], [], [], [], 0
        for tree in trees:
            parent += [p + base if p >= 0 else -1 for p in tree.parent]
            depth += tree.depth
            kind += [_kind(t) for t in tree.tag]
            for node, seen in enumerate(node_features(tree)):
                owner += [base + node] * len(seen)
                feature += seen
            base += len(tree.tag)
        deep = np.array(depth, np.int64)
        order = np.argsort(deep, kind="stable")
        levels = np.split(order, np.cumsum(np.bincount(deep))[:-1]) if len(deep) else []
        return cls(np.array(parent, np.int64), np.array(kind, np.int64), levels, np.array(owner, np.int64),
                   np.array(feature, np.int64))


@dataclass
class PageModel:
    """Weights of features, and potentials (kind of child, parent's state, child's state)."""

    weights: np.ndarray
    edges: np.ndarray

    def marginals(self, forest: Forest) -> tuple[np.ndarray, np.ndarray]:
        """Probability of main text of every node, and the joint one of (parent's state, own state) of every child."""
        size = len(forest.parent)
        node = np.zeros((size, 2))
        node[:, 1] = np.bincount(forest.owner, self.weights[forest.feature], size)
        up, down = np.zeros((size, 2)), np.zeros((size, 2))
        inner = node.copy()  # potentials of a node and all messages from below
        for level in forest.levels[:0:-1]:
            both = inner[level][:, None, :] + self.edges[forest.kind[level]]
            up[level] = np.logaddexp(both[:, :, 0], both[:, :, 1])
            np.add.at(inner, forest.parent[level], up[level])
        joint = np.zeros((size, 2, 2))
        for level in forest.levels[1:]:
            above = inner[forest.parent[level]] + down[forest.parent[level]] - up[level]
            both = above[:, :, None] + self.edges[forest.kind[level]]
            down[level] = np.logaddexp(both[:, 0, :], both[:, 1, :])
            full = both + inner[level][:, None, :]
            full = np.exp(full - full.max(axis=(1, 2), keepdims=True))
            joint[level] = full / full.sum(axis=(1, 2), keepdims=True)
        belief = inner + down
        return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -500, 500))), joint


def main_labels(tree: Tree) -> np.ndarray:
    """Labels from the nearest ``data-main``."""
    label = np.zeros(len(tree.tag), np.int64)
    for node in range(1, len(tree.tag)):
        given = tree.attributes[node].get("data-main")
        label[node] = int(given) if given in ("0", "1") else label[tree.parent[node]]
    return label


def fit_pages(pages: list[str], steps: int = STEPS) -> PageModel:
    """Gradient ascent (Adam) on the likelihood of labelled pages."""
    trees = [parse(p) for p in pages]
    forest = Forest.of(trees)
    label = np.concatenate([main_labels(t) for t in trees])
    children = forest.parent >= 0
    truth = np.zeros((len(KINDS), 2, 2))
    np.add.at(truth, (forest.kind[children], label[forest.parent[children]], label[children]), 1)
    seen = np.bincount(forest.feature, label[forest.owner], FEATURES)
    model = PageModel(np.zeros(FEATURES), np.zeros((len(KINDS), 2, 2)))
    state = [np.zeros(FEATURES), np.zeros(FEATURES), np.zeros_like(truth), np.zeros_like(truth)]
    for step in range(1, steps + 1):
        belief, joint = model.marginals(forest)
        expected = np.zeros_like(truth)
        np.add.at(expected, forest.kind[children], joint[children])
        slopes = ((seen - np.bincount(forest.feature, belief[forest.owner], FEATURES)) / len(pages) - 2e-3 * model.weights,
                  (truth - expected) / len(pages) - 2e-3 * model.edges)
        for i, (values, slope) in enumerate(zip((model.weights, model.edges), slopes)):
            state[2 * i] = 0.9 * state[2 * i] + 0.1 * slope
            state[2 * i + 1] = 0.99 * state[2 * i + 1] + 0.01 * slope ** 2
            values += 0.1 * (state[2 * i] / (1 - 0.9 ** step)) / (np.sqrt(state[2 * i + 1] / (1 - 0.99 ** step)) + 1e-6)
    return model


def main_texts(pages: list[str | None], model: PageModel) -> list[str]:
    """Main text of every page."""
    trees = [parse(p) for p in pages]
    belief, _ = model.marginals(Forest.of(trees))
    found, base = [], 0
    for tree in trees:
        found.append(" ".join(blocks(tree, belief[base:base + len(tree.tag)] > 0.5)))
        base += len(tree.tag)
    return found


def extract_main_text(pages: DataFrame, model: PageModel | None = None, id_col: str = "page_id", url_col: str = "url",
                      html_col: str = "html") -> DataFrame:
    """Id, url and main ``text`` of every row of ``pages``."""
    model = model or fit_pages(labelled_pages())
    picked = pages.select(pages[id_col].alias(id_col), pages[url_col].alias(url_col), pages[html_col].alias("_html"))
    shared = pages.sparkSession.sparkContext.broadcast((model.weights, model.edges))
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema[:2]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = PageModel(*shared.value)
        for batch in batches:
            held = batch.column(2).to_pylist()
            start = 0
            while start < len(held):
                end, chars = start, 0
                while end < len(held) and (end == start or chars + len(held[end] or "") <= FOREST_CHARS):
                    chars += len(held[end] or "")
                    end += 1
                texts = main_texts(held[start:end], known)
                part = batch.slice(start, end - start)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())],
                                                 names=[id_col, url_col, "text"])
                start = end

    return picked.mapInArrow(run, ", ".join([*kinds, "text string"]))
