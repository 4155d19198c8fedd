"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedworks.llm.common import written


def connected_components(edges: DataFrame) -> DataFrame:
    """Each node of ``edges`` (a, b; whole numbers) with the smallest node of its component.

    Large-star and small-star steps in turn: neighbours are tied to the smallest node that
    either step sees, until every component is a star around its smallest node. That takes
    a number of rounds that grows with the logarithm of a component's size. Minima are
    taken before rows are joined to them, so a node with very many neighbours is
    aggregated map-side and joined as a skewed key, never gathered. Every round is a
    written table. Self-loops and repeated edges are allowed; a node without any other
    is not in the result unless a loop names it.
    """
    loops = edges.where("a = b").select(F.col("a").alias("node"))
    step = written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(), "edges"
    )
    state = _state(step)
    while True:
        both = step.select("v", "u").union(step.select("u", "v"))
        lowest = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m"))
        large = both.join(lowest, "v").where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u")).distinct()
        large = written(large, "large-star")
        lowest = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(lowest, "v").where("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u"))
        step = written(small.union(lowest).distinct(), "small-star")
        before, state = state, _state(step)
        if state == before:
            break
    stars = step.select(F.col("v").alias("node"), F.col("u").alias("component"))
    centres = step.select(F.col("u").alias("node")).distinct().select("node", F.col("node").alias("component"))
    known = stars.unionByName(centres)
    lonely = loops.distinct().join(known, "node", "left_anti").select("node", F.col("node").alias("component"))
    return known.unionByName(lonely)


def _state(edges: DataFrame) -> tuple:
    """A count and a digest of the edges: both stay the same once nothing changes."""
    # Edges are distinct; unlike a sum, the exclusive or of their hashes cannot overflow.
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("v", "u")), F.bit_xor(F.xxhash64("u", "v"))).first())
