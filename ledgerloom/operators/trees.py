"""Small numpy helpers that grow one tree and walk many.

They see one bounded sample or one daily series at a time; Spark decides which rows
meet, and runs one call per (series, block of trees).
A forest is five parallel arrays over all nodes of its trees; a negative feature marks
a leaf, and ``roots`` holds where each tree starts.
"""

from __future__ import annotations

import zlib

import numpy as np


def seeded(*parts) -> np.random.Generator:
    """A generator that depends only on the given key parts."""
    return np.random.default_rng(zlib.crc32("|".join(map(str, parts)).encode()))


class Forest:
    def __init__(self):
        self.feature: list[int] = []
        self.threshold: list[float] = []
        self.left: list[int] = []
        self.right: list[int] = []
        self.value: list[float] = []
        self.roots: list[int] = []

    def node(self, value: float) -> int:
        for array, item in (
            (self.feature, -1), (self.threshold, 0.0), (self.left, 0), (self.right, 0),
            (self.value, value),
        ):
            array.append(item)
        return len(self.feature) - 1

    def split(self, at: int, feature: int, threshold: float, left: int, right: int) -> None:
        self.feature[at], self.threshold[at] = int(feature), float(threshold)
        self.left[at], self.right[at] = left, right

    def columns(self) -> dict:
        return {
            "feature": self.feature, "threshold": self.threshold, "left": self.left,
            "right": self.right, "value": self.value, "roots": self.roots,
        }


FOREST_FIELDS = (
    "feature array<int>, threshold array<double>, left array<int>, right array<int>, "
    "value array<double>, roots array<int>"
)


def path_length(n: int) -> float:
    """Mean depth of an unsuccessful search among ``n`` points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (np.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n


def grow_isolation(forest: Forest, x: np.ndarray, rng: np.random.Generator, depth: int) -> None:
    """One isolation tree: random feature that still varies, random cut between its ends.
    A leaf's value is its depth plus the expected depth of the points left in it."""
    root = forest.node(0.0)
    forest.roots.append(root)
    todo = [(root, x, 0)]
    while todo:
        at, part, level = todo.pop()
        low, high = part.min(axis=0), part.max(axis=0)
        varying = np.flatnonzero(high > low)
        if level >= depth or len(part) <= 1 or varying.size == 0:
            forest.value[at] = level + path_length(len(part))
            continue
        f = rng.choice(varying)
        cut = rng.uniform(low[f], high[f])
        goes_left = part[:, f] <= cut
        left, right = forest.node(0.0), forest.node(0.0)
        forest.split(at, f, cut, left, right)
        todo += [(left, part[goes_left], level + 1), (right, part[~goes_left], level + 1)]


def best_split(x: np.ndarray, y: np.ndarray, w: np.ndarray, order: np.ndarray, min_leaf: int):
    """(feature, threshold) with the largest drop of squared error, or None.

    ``order`` lists the node's rows by each feature, one feature per line.
    """
    n = order.shape[1]
    xs = np.take_along_axis(x.T, order, axis=1)
    weight = w[order]
    ws = np.cumsum(weight, axis=1)
    wy = np.cumsum(weight * y[order], axis=1)
    wl, yl = ws[:, min_leaf - 1 : n - min_leaf], wy[:, min_leaf - 1 : n - min_leaf]
    gain = yl * yl / wl + (wy[:, -1:] - yl) ** 2 / (ws[:, -1:] - wl)
    gain[xs[:, min_leaf - 1 : n - min_leaf] == xs[:, min_leaf : n - min_leaf + 1]] = -np.inf
    f, at = divmod(int(np.argmax(gain)), gain.shape[1])
    if not gain[f, at] > wy[0, -1] ** 2 / ws[0, -1] + 1e-12:
        return None
    at += min_leaf - 1
    return f, (xs[f, at] + xs[f, at + 1]) / 2.0


def grow_regression(
    forest: Forest, x: np.ndarray, y: np.ndarray, order: np.ndarray, rng: np.random.Generator,
    depth: int, min_leaf: int,
) -> None:
    """One regression tree on a bootstrap sample; drawn copies of a row are its weight.

    Rows are sorted once per series (``order``); a node keeps its part of that order.
    """
    w = np.bincount(rng.integers(len(y), size=len(y)), minlength=len(y)).astype(float)
    root = forest.node(0.0)
    forest.roots.append(root)
    lines = order.shape[0]
    todo = [(root, order[w[order] > 0].reshape(lines, -1), 0)]
    while todo:
        at, part, level = todo.pop()
        rows = part[0]
        forest.value[at] = float(np.dot(w[rows], y[rows]) / w[rows].sum())
        if level >= depth or len(rows) < 2 * min_leaf:
            continue
        found = best_split(x, y, w, part, min_leaf)
        if found is None:
            continue
        f, threshold = found
        goes_left = (x[:, f] <= threshold)[part]
        left, right = forest.node(0.0), forest.node(0.0)
        forest.split(at, f, threshold, left, right)
        todo.append((left, part[goes_left].reshape(lines, -1), level + 1))
        todo.append((right, part[~goes_left].reshape(lines, -1), level + 1))


def join_blocks(blocks) -> dict[str, np.ndarray]:
    """One forest from the rows of several blocks; node numbers are shifted."""
    shift, parts = 0, {name: [] for name in Forest().columns()}
    for block in blocks:
        for name, values in parts.items():
            array = np.asarray(getattr(block, name))
            values.append(array + shift if name in ("left", "right", "roots") else array)
        shift += len(block.feature)
    return {name: np.concatenate(values) for name, values in parts.items()}


def leaf_values(forest: dict[str, np.ndarray], x: np.ndarray, depth: int) -> np.ndarray:
    """Mean leaf value over all trees for every row of ``x``."""
    feature, threshold = forest["feature"], forest["threshold"]
    left, right = forest["left"], forest["right"]
    total = np.zeros(len(x))
    rows = np.arange(len(x))
    for root in forest["roots"]:
        at = np.full(len(x), root)
        for _ in range(depth):
            f = feature[at]
            step = np.where(x[rows, f] <= threshold[at], left[at], right[at])
            at = np.where(f >= 0, step, at)
        total += forest["value"][at]
    return total / len(forest["roots"])


def leaf_values_one(forest: dict[str, np.ndarray], x: np.ndarray, depth: int) -> float:
    """The same for a single row, all trees at once."""
    at = forest["roots"]
    for _ in range(depth):
        f = forest["feature"][at]
        step = np.where(x[f] <= forest["threshold"][at], forest["left"][at], forest["right"][at])
        at = np.where(f >= 0, step, at)
    return float(forest["value"][at].mean())
