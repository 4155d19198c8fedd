"""Helpers over several frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames, columns matched by name.

    Frames are united in pairs, then pairs of pairs: each step analyses what it unites
    again, so a chain of n frames would cost n * n, this costs n log n.
    """
    if not frames:
        raise ValueError("nothing to unite")
    level = list(frames)
    while len(level) > 1:
        pairs = [level[i].unionByName(level[i + 1]) for i in range(0, len(level) - 1, 2)]
        level = pairs + level[len(pairs) * 2 :]
    return level[0]
