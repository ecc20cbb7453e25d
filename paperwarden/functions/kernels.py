"""Numpy helpers that run inside Arrow batches on the executors."""

from __future__ import annotations

import difflib
import math

import numpy as np

from .fixed_values import EULER_GAMMA


def matching_ratio(name: str, known: str) -> float:
    """Ratcliff-Obershelp similarity, 2 * matched / total length."""
    return difflib.SequenceMatcher(None, name, known).ratio()


def average_path(size):
    """Mean depth of an unsuccessful search in a binary tree of ``size`` points."""
    size = np.asarray(size, dtype="float64")
    safe = np.maximum(size, 3.0)
    long = 2.0 * (np.log(safe - 1.0) + EULER_GAMMA) - 2.0 * (safe - 1.0) / safe
    return np.where(size <= 1, 0.0, np.where(size == 2, 1.0, long))


def tree_depth(subsample: int) -> int:
    return max(1, math.ceil(math.log2(max(subsample, 2))))


def grow_tree(points: np.ndarray, depth: int, rng: np.random.Generator):
    """Random cuts over ``points``; rows (node, feature, threshold, size, depth), children at 2n+1, 2n+2.

    A node is a leaf (feature -1) at the depth limit, with one point, or when no feature varies.
    """
    nodes = []
    todo = [(0, 0, points)]
    while todo:
        node, level, rows = todo.pop()
        low, high = (rows.min(axis=0), rows.max(axis=0)) if len(rows) else (np.zeros(0), np.zeros(0))
        varying = np.flatnonzero(high > low)
        if level >= depth or len(rows) <= 1 or len(varying) == 0:
            nodes.append((node, -1, 0.0, len(rows), level))
            continue
        feature = int(rng.choice(varying))
        threshold = float(rng.uniform(low[feature], high[feature]))
        if threshold >= high[feature]:
            threshold = float(low[feature])
        left = rows[:, feature] <= threshold
        nodes.append((node, feature, threshold, len(rows), level))
        todo.append((2 * node + 1, level + 1, rows[left]))
        todo.append((2 * node + 2, level + 1, rows[~left]))
    return nodes


class ForestArrays:
    """All trees as complete binary trees in flat arrays, for vectorised scoring."""

    def __init__(self, tree, node, feature, threshold, size, depth, subsample: int):
        self.levels = tree_depth(subsample)
        self.width = 2 ** (self.levels + 1) - 1
        self.normaliser = float(average_path(subsample))
        self.trees = int(len(np.unique(tree)))
        position = np.searchsorted(np.unique(tree), tree)
        shape = (self.trees, self.width)
        self.feature = np.zeros(shape, dtype="int64")
        self.threshold = np.full(shape, np.inf)
        self.path = np.zeros(shape)
        inner = feature >= 0
        self.feature[position[inner], node[inner]] = feature[inner]
        self.threshold[position[inner], node[inner]] = threshold[inner]
        leaf = ~inner
        self.path[position[leaf], node[leaf]] = depth[leaf] + average_path(size[leaf])
        # A leaf above the last level hands its path length down the left-most way.
        for n in range(2 ** self.levels - 1):
            passed = np.isinf(self.threshold[:, n])
            self.path[passed, 2 * n + 1] = self.path[passed, n]

    def _descend(self, feature, threshold, columns: np.ndarray, apart: int, at: np.ndarray, first: np.ndarray | None = None) -> np.ndarray:
        """The last node on the way of each row. Its value of feature f is at ``f * apart + at`` in ``columns``, its
        tree begins at ``first`` in ``feature`` and ``threshold``. Buffers are used again from level to level."""
        count = len(at)
        node, place = np.zeros(count, dtype="int64"), np.empty(count, dtype="int64")
        value, cut, right = np.empty(count), np.empty(count), np.empty(count, dtype=bool)
        start = feature * apart
        for _ in range(self.levels):
            entry = node if first is None else node + first
            np.take(start, entry, out=place, mode="clip")
            np.add(place, at, out=place)
            np.take(columns, place, out=value, mode="clip")
            np.take(threshold, entry, out=cut, mode="clip")
            np.greater(value, cut, out=right)
            np.add(node, node, out=node)
            np.add(node, right, out=node)
            np.add(node, 1, out=node)
        return node

    def _scores(self, total: np.ndarray) -> np.ndarray:
        if self.normaliser == 0.0:
            return np.full(total.shape, 0.5)
        return np.power(2.0, -total / (self.trees * self.normaliser))

    def score(self, rows: np.ndarray, batch: int = 8192) -> np.ndarray:
        """2 ** -(mean path / normaliser) per row, in (0, 1]; higher is more unusual."""
        scores = np.empty(len(rows))
        for start in range(0, len(rows), batch):
            part = rows[start:start + batch]
            count = len(part)
            columns, at, total = np.ascontiguousarray(part.T).ravel(), np.arange(count), np.zeros(count)
            for t in range(self.trees):
                total += self.path[t].take(self._descend(self.feature[t], self.threshold[t], columns, count, at))
            scores[start:start + batch] = self._scores(total)
        return scores

    def _turns(self, medians: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether the median goes right at each node, and the features whose median leaves the way to each node."""
        right = medians[self.feature] > self.threshold
        turns = np.zeros((self.trees, len(medians), self.width), dtype=bool)
        every = np.arange(self.trees)
        for n in range(2 ** self.levels - 1):
            for child, leaves in ((2 * n + 1, right[:, n]), (2 * n + 2, ~right[:, n])):
                turns[:, :, child] = turns[:, :, n]
                turns[every[leaves], self.feature[leaves, n], child] = True
        return right, turns

    def contributions(self, rows: np.ndarray, medians: np.ndarray, batch: int = 4096):
        """(scores, drop of the score when one feature is set to its median), batch by batch.

        A row goes down a tree again only for the features whose median takes another turn on its way; in a tree where
        it doesn't, the row keeps its path.
        """
        count = rows.shape[1]
        scores, drops = np.empty(len(rows)), np.zeros(rows.shape)
        right, turns = self._turns(medians)
        ahead = np.where(right, -1.0, 1.0)
        own = np.arange(count)[:, None]
        for start in range(0, len(rows), batch):
            part = rows[start:start + batch]
            n = len(part)
            # A column of zeros stands for a feature at its median: cuts below or above zero send it there.
            columns, at = np.append(np.ascontiguousarray(part.T).ravel(), np.zeros(n)), np.arange(n)
            total, changed = np.zeros(n), np.zeros((count, n))
            for t in range(self.trees):
                leaf = self._descend(self.feature[t], self.threshold[t], columns, n, at)
                path = self.path[t].take(leaf)
                total += path
                again = np.flatnonzero(turns[t].take(leaf, axis=1))
                before = changed.take(again)
                changed += path
                if len(again):
                    feature, row = np.divmod(again, n)
                    fixed = self.feature[t] == own
                    last = self._descend(np.where(fixed, count, self.feature[t]).ravel(),
                                         np.where(fixed, ahead[t], self.threshold[t]).ravel(),
                                         columns, n, row, feature * self.width)
                    changed.put(again, before + self.path[t].take(last))
            scores[start:start + batch] = self._scores(total)
            drops[start:start + batch] = (scores[start:start + batch] - self._scores(changed)).T
        return scores, drops
