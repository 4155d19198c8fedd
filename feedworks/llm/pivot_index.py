"""Exact top-k search by a pivot-distance index.

Every vector is keyed by its nearest pivot and its distance from it; sorted by that key, a
pivot's vectors form annuli. By the triangle inequality a vector in an annulus from
``lo`` to ``hi`` is at least ``d - hi`` and at least ``lo - d`` away from a query that is ``d``
away from the pivot. Annuli are gone through from the nearest outwards, until the bound
leaves nothing closer than the k-th best so far; which that is loses nothing, so results
are exact. Nearness is the largest inner product, turned into a distance by giving all vectors
one length with a component more. The pivots are chosen far apart from a bounded sample.

Null vectors, and those without or with non-finite components, take no part; neither
do null ids. Vectors shorter than others count as ending in zeros. Rows that repeat an id are
candidates and queries of their own; a query leaves out its own row only. Ties go to the smaller id. Fewer candidates than ``k`` are all
returned; an empty table gives an empty table. Other columns are not used. Products of whole
numbers are exact as long as they fit a long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame

from feedworks.llm.vectors import Index, search

PIVOTS = 64


class PivotIndex(Index):
    def __init__(self, sample: np.ndarray, longest: float):
        self.longest = longest
        chosen = [0]
        away = self.distances(sample, sample[:1])[:, 0]
        while len(chosen) < min(PIVOTS, len(sample)) and away.max() > 0:
            chosen.append(int(away.argmax()))
            away = np.minimum(away, self.distances(sample, sample[chosen[-1:]])[:, 0])
        self.pivots = sample[chosen]

    @staticmethod
    def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        square = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2 * x @ y.T
        return np.sqrt(np.maximum(square, 0))

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        away = self.distances(x, self.pivots)
        nearest = away.argmin(axis=1)
        return nearest, away[np.arange(len(x)), nearest]

    def from_pivots(self, q: np.ndarray) -> np.ndarray:
        return self.distances(np.pad(q, ((0, 0), (0, 1))), self.pivots)

    def reach(self, q: np.ndarray, least: np.ndarray) -> np.ndarray:
        # Distances were worked out in floating point: a little more than the bound itself.
        return self.distance(q, least) + 1e-6 * (1 + self.longest)

    def wanted(self, q: np.ndarray, reach: np.ndarray) -> Iterator[tuple[int, float, float, float, float]]:
        away = self.from_pivots(q)
        for p in range(len(self.pivots)):
            d = away[:, p]
            yield p, float((d - reach).min()), float((d + reach).max()), float(d.min()), float(d.max())

    def needed(self, q: np.ndarray, reach: np.ndarray, x: np.ndarray, region: int) -> np.ndarray:
        d = self.from_pivots(q)[:, region]
        r = self.distances(x, self.pivots[region : region + 1])[:, 0]
        return ((d - r.max() <= reach) & (r.min() - d <= reach))[:, None]


def exact_top_k(
    df: DataFrame, k: int, is_query: Column, vec_id: str = "vec_id", vector: str = "embedding", whole: bool = False
) -> DataFrame:
    """Each query's ``k`` largest inner products: query_id, rank, vec_id, score.

    ``whole`` says that all components are whole numbers; scores are then longs.
    """
    return search(df, k, is_query, vec_id, vector, PivotIndex, np.int64 if whole else np.float64)
