"""Approximate nearest neighbours from a few stable projections.

Vectors are projected on ``PROJECTIONS`` random directions with normal components. The squared
projected distance of two vectors, over their squared distance, follows a chi-square
distribution, so a vector nearer than the k-th best so far has a projected distance beyond

    (distance of the k-th best) * sqrt(chi-square quantile of ``CONFIDENCE``)

with a probability of at most ``1 - CONFIDENCE``: the search stops there. A kd-tree
over the projections of a bounded sample cuts the projected space into cells, every row is put
in its cell, and cells are cut into blocks along their widest direction. Blocks are gone
through by their projected distance from the query; in them the rows within reach
are verified on the original vectors, and each that is found shortens the reach.

Nearness is the largest inner product, turned into a distance by giving all vectors one
length with a component more. Null, zero and non-finite vectors take no part, neither
do null ids; shorter vectors count as ending in zeros; rows that repeat an id are candidates and
queries of their own, and a query leaves out its own row only; ties go to the smaller id. Fewer candidates than ``k`` are all returned, an
empty table gives an empty table. Other columns are not used.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import exp, lgamma, log, sqrt

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedworks.llm.vectors import Index, search

PROJECTIONS = 10
CONFIDENCE = 0.98
#: Cells of the tree, as a power of two.
LEVELS = 6


def chi_square_quantile(p: float, degrees: int) -> float:
    """The value that a chi-square variable stays below with probability ``p``."""

    def below(x: float) -> float:  # the regularised lower gamma function, by its series
        half, term = degrees / 2, 1.0
        total, n = 1.0, half
        while term > 1e-15 * total:
            n += 1
            term *= x / 2 / n
            total += term
        return total * exp(-x / 2 + half * log(x / 2) - lgamma(half + 1))

    low, high = 1e-9, 10.0 * degrees + 100
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < p else (low, middle)
    return high


class ProjectionTree(Index):
    def __init__(self, sample: np.ndarray, longest: float, seed: int = 7):
        self.longest = longest
        self.directions = np.random.default_rng(seed).standard_normal((sample.shape[1], PROJECTIONS))
        self.factor = sqrt(chi_square_quantile(CONFIDENCE, PROJECTIONS))
        y = sample @ self.directions
        # The tree in level order: an axis and a cut for each inner node.
        inner = (1 << LEVELS) - 1
        self.axis, self.cut = np.zeros(inner, int), np.zeros(inner)
        groups = {0: y}
        for node in range(inner):
            own = groups.pop(node)
            if len(own):
                self.axis[node] = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
                self.cut[node] = np.median(own[:, self.axis[node]])
            right = own[:, self.axis[node]] > self.cut[node]
            groups[2 * node + 1], groups[2 * node + 2] = own[~right], own[right]
        # Rows of a cell are sorted along the direction in which its sample is widest.
        self.sort_axis = np.array(
            [int(np.argmax(np.ptp(groups[inner + c], axis=0))) if len(groups[inner + c]) else 0 for c in range(inner + 1)]
        )
        # Each cell's bounds, from the cuts above it.
        self.low, self.high = (np.full((inner + 1, PROJECTIONS), v) for v in (-np.inf, np.inf))
        for c in range(inner + 1):
            node = c + inner
            while node:
                up = (node - 1) // 2
                a = self.axis[up]
                if node == 2 * up + 1:
                    self.high[c, a] = min(self.high[c, a], self.cut[up])
                else:
                    self.low[c, a] = max(self.low[c, a], self.cut[up])
                node = up

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        y = x @ self.directions
        node = np.zeros(len(y), int)
        for _ in range(LEVELS):
            node = 2 * node + 1 + (y[np.arange(len(y)), self.axis[node]] > self.cut[node])
        cell = node - ((1 << LEVELS) - 1)
        return cell, y[np.arange(len(y)), self.sort_axis[cell]]

    def projected(self, q: np.ndarray) -> np.ndarray:
        return q @ self.directions[:-1]

    def reach(self, q: np.ndarray, least: np.ndarray) -> np.ndarray:
        return self.distance(q, least) * self.factor

    @staticmethod
    def gaps(y: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Distances of points from a box."""
        outside = np.maximum(np.maximum(low - y, y - high), 0)
        return np.sqrt((outside * outside).sum(axis=1))

    def wanted(self, q: np.ndarray, reach: np.ndarray) -> Iterator[tuple[int, float, float, float, float]]:
        y = self.projected(q)
        for c in range(len(self.sort_axis)):
            near = self.gaps(y, self.low[c], self.high[c]) <= reach
            if near.any():
                key = y[near, self.sort_axis[c]]
                yield c, float((key - reach[near]).min()), float((key + reach[near]).max()), float(key.min()), float(key.max())

    def needed(self, q: np.ndarray, reach: np.ndarray, x: np.ndarray, region: int) -> np.ndarray:
        y, z = self.projected(q), x @ self.directions
        out = np.zeros((len(q), len(x)), bool)
        at = np.flatnonzero(self.gaps(y, z.min(axis=0), z.max(axis=0)) <= reach)
        square = (y[at] ** 2).sum(axis=1)[:, None] + (z * z).sum(axis=1)[None, :] - 2 * y[at] @ z.T
        out[at] = square <= (reach[at] ** 2)[:, None]
        return out


def approximate_top_k(
    df: DataFrame, k: int, is_query: Column, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """Each query's ``k`` nearest found, by inner product: query_id, rank, vec_id, score."""
    some = df.where(F.exists(F.col(vector).cast("array<double>"), lambda x: x != 0))
    return search(some, k, is_query, vec_id, vector, ProjectionTree, np.float64)
