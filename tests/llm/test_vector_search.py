"""The two vector searches against comparing everything."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedworks.llm import vectors
from feedworks.llm.pivot_index import PivotIndex, exact_top_k
from feedworks.llm.projection_tree import ProjectionTree, approximate_top_k, chi_square_quantile

SCHEMA = "vec_id long, embedding array<double>, label string, region int"


def clustered(n, width=12, seed=0, lengths=True):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, width))
    x[: n // 3] = x[0] + 0.05 * x[: n // 3]  # a third of all in one place
    if lengths:
        x *= rng.uniform(0.2, 3, (n, 1))
    return x


def brute(ids, x, k, queries):
    out = {}
    s = x @ x.T
    for i in np.flatnonzero(queries):
        others = np.flatnonzero(ids != ids[i])
        best = others[np.lexsort((ids[others], -s[i, others]))][:k]
        out[int(ids[i])] = [(int(ids[j]), s[i, j]) for j in best]
    return out


def table(spark, ids, x):
    return spark.createDataFrame([(int(i), v.tolist(), "x", 1) for i, v in zip(ids, x)], SCHEMA)


def lists(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


@pytest.mark.parametrize("blocks, queries, sample", [(4096, 1024, 4096), (16, 8, 40)])
def test_exact_search_equals_brute_force(spark, monkeypatch, blocks, queries, sample):
    monkeypatch.setattr(vectors, "BLOCK", blocks)
    monkeypatch.setattr(vectors, "QUERIES", queries)
    monkeypatch.setattr(vectors, "SAMPLE", sample)
    x = np.floor(clustered(400) * 4)  # small whole numbers: many ties
    ids = np.random.default_rng(1).permutation(5000)[:400]
    got = lists(exact_top_k(table(spark, ids, x), 5, F.col("vec_id") % 7 == 0, whole=True))
    assert got == brute(ids, x, 5, ids % 7 == 0)


def test_exact_search_on_real_numbers(spark):
    x = clustered(300, seed=2)
    ids = np.arange(300)
    got = lists(exact_top_k(table(spark, ids, x), 3, F.col("vec_id") % 10 == 0))
    want = brute(ids, x, 3, ids % 10 == 0)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}


def test_the_pivot_bound_skips_and_never_loses():
    x = vectors.lifted(clustered(2000, seed=3), 30.0)
    index = PivotIndex(x[:500], 30.0)
    region, key = index.place(x)
    q = x[::100, :-1]
    scores = q @ x[:, :-1].T
    least = np.sort(scores, axis=1)[:, -5]
    reach = index.reach(q, least)
    skipped = 0
    for r in np.unique(region):
        at = np.flatnonzero(region == r)
        for half in np.array_split(at[np.argsort(key[at])], 4):
            if len(half):
                needed = index.needed(q, reach, x[half], r)[:, 0]
                skipped += int((~needed).sum())
                assert not (scores[np.ix_(~needed, half)] >= least[~needed][:, None]).any()
    assert skipped > 0


def test_approximate_search_finds_nine_of_ten(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 64)
    x = clustered(1500, width=24, seed=4)
    ids = np.arange(1500)
    got = lists(approximate_top_k(table(spark, ids, x), 10, F.col("vec_id") % 30 == 0))
    want = brute(ids, x, 10, ids % 30 == 0)
    hits = sum(len({i for i, _ in want[q]} & {i for i, _ in got[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)
    for q, found in got.items():
        assert len(found) == 10
        for i, s in found:
            assert s == pytest.approx(x[q] @ x[i], abs=1e-12)
        assert [s for _, s in found] == sorted((s for _, s in found), reverse=True)


def test_the_stopping_rule_verifies_less_than_everything():
    x = clustered(3000, width=24, seed=5, lengths=False)
    x /= np.linalg.norm(x, axis=1)[:, None]
    x = vectors.lifted(x, 1.0)
    tree = ProjectionTree(x[::3], 1.0)
    cell, _ = tree.place(x)
    q = x[:1000:50, :-1]
    least = np.sort(q @ x[:, :-1].T, axis=1)[:, -5]
    reach = tree.reach(q, least)
    verified = sum(int(tree.needed(q, reach, x[cell == c], c).sum()) for c in np.unique(cell))
    assert 0 < verified < 0.9 * len(q) * len(x)
    # A cell that is not wanted has no row within reach.
    wanted = {w[0] for w in tree.wanted(q, reach)}
    for c in set(np.unique(cell)) - wanted:
        assert not tree.needed(q, reach, x[cell == c], c).any()


def test_chi_square_quantiles():
    # Published table values.
    for p, degrees, value in ((0.95, 1, 3.841), (0.95, 10, 18.307), (0.99, 10, 23.209), (0.5, 4, 3.357)):
        assert chi_square_quantile(p, degrees) == pytest.approx(value, abs=1e-3)


@pytest.mark.parametrize("search", [exact_top_k, approximate_top_k])
def test_odd_vectors(spark, search):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], "q", 1), (1, [2.0, 0.0], "", 1), (2, [2.0], "short", 1), (3, None, "", 1), (4, [nan, 1.0], "", 1),
        (5, [inf, 1.0], "", 1), (6, [None, 1.0], "", 1), (7, [], "", 1), (None, [9.0, 9.0], "", 1), (8, [1.0, 0.0], "", 1),
        (8, [3.0, 0.0], "repeat", 1), (10, [5.0, 5.0], "other query", 1),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    got = lists(search(df, 10, F.col("vec_id") % 10 == 0))
    assert got == {
        0: [(10, 5.0), (8, 3.0), (1, 2.0), (2, 2.0), (8, 1.0)],
        10: [(8, 15.0), (1, 10.0), (2, 10.0), (0, 5.0), (8, 5.0)],
    }
    assert search(df.limit(0), 3, F.lit(True)).count() == 0
    assert search(df.where("vec_id = 0"), 3, F.lit(True)).count() == 0
    assert search(df, 3, F.lit(False)).count() == 0


def test_zero_vectors(spark):
    df = spark.createDataFrame([(0, [0.0, 0.0], "", 1), (1, [-1.0, 0.0], "", 1), (2, [1.0, 0.0], "", 1)], SCHEMA)
    assert lists(exact_top_k(df, 5, F.col("vec_id") == 1)) == {1: [(0, 0.0), (2, -1.0)]}
    assert lists(approximate_top_k(df, 5, F.col("vec_id") < 2)) == {1: [(2, -1.0)]}


def test_whole_numbers_with_fewer_candidates_than_k(spark):
    rows = [(0, [256.0, 0.0], "", 1), (1, [-256.0, 0.0], "", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = lists(exact_top_k(df, 5, F.lit(True), whole=True))
    assert got == {0: [(1, -65536)], 1: [(0, -65536)]}
    nan = float("nan")
    rows += [(2, [0.0, 0.0], "", 1), (3, [300.0], "short", 1), (4, None, "", 1), (5, [nan, 1.0], "", 1), (None, [9.0], "", 1)]
    got = lists(exact_top_k(spark.createDataFrame(rows, SCHEMA), 5, F.col("vec_id") < 2, whole=True))
    assert got == {0: [(3, 76800), (2, 0), (1, -65536)], 1: [(2, 0), (0, -65536), (3, -76800)]}


def with_copies(n=600, width=8, seed=11):
    """Half of all vectors equal, some ids repeated with equal and with other vectors."""
    rng = np.random.default_rng(seed)
    x = np.floor(rng.standard_normal((n, width)) * 4)
    x[::2] = x[0]
    ids = rng.permutation(n)
    ids[3], ids[5], ids[7], ids[9] = ids[1], ids[1], ids[0], ids[0]
    x[5] = x[1]
    return ids, x


def brute_rows(ids, x, k, asks):
    """Each query row's best of all other rows, as a sorted list over all query rows."""
    s = x @ x.T
    out = []
    for i in np.flatnonzero(asks):
        others = np.delete(np.arange(len(ids)), i)
        best = others[np.lexsort((ids[others], -s[i, others]))][:k]
        out += [(int(ids[i]), rank + 1, int(ids[j]), s[i, j]) for rank, j in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("partitions", ["3", "41"])
@pytest.mark.parametrize("blocks, queries, sample", [(4096, 1024, 4096), (16, 8, 40)])
def test_equal_vectors_and_repeated_ids(spark, monkeypatch, partitions, blocks, queries, sample):
    """What is found does not depend on partitions, blocks or the sample."""
    for name, value in (("BLOCK", blocks), ("QUERIES", queries), ("SAMPLE", sample)):
        monkeypatch.setattr(vectors, name, value)
    ids, x = with_copies()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        found = exact_top_k(table(spark, ids, x).repartition(int(partitions)), 5, F.col("vec_id") % 7 == 0, whole=True)
        got = sorted(tuple(r) for r in found.collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == brute_rows(ids, x, 5, ids % 7 == 0)


def test_rows_from_a_block_are_bounded_by_what_is_asked():
    """A block of many equal scores gives ``k`` rows, those with the smallest ids."""
    ids = np.full((1000, 6), vectors.NO_ID)
    ids[:, 0] = np.arange(1000)[::-1]
    ids[7, :6] = [992, 992, 1000, 1001, 1002, 1003]
    of, place, names, scores = vectors.best_rows(np.full(1000, 3), np.ones(1000, bool), ids, 6)
    assert names.tolist() == [0, 1, 2, 3, 4, 5] and of.tolist() == [999, 998, 997, 996, 995, 994]
    of, place, names, scores = vectors.best_rows(np.where(np.arange(1000) == 7, 9, 3), np.ones(1000, bool), ids, 6)
    assert names.tolist() == [992, 992, 1000, 1001, 1002, 1003] and set(of) == {7} and place.tolist() == [0, 1, 2, 3, 4, 5]


def test_cuts_follow_the_sample_and_no_region_is_mixed():
    rng = np.random.default_rng(3)
    region, key = rng.integers(0, 5, 1000), rng.standard_normal(1000)
    cuts = vectors.Cuts(region, key)
    part = cuts.in_regions(20)(region, key)
    assert all(len(set(region[part == p])) == 1 for p in np.unique(part)) and 15 <= len(np.unique(part)) <= 25
    order = np.lexsort((key, region))
    ranks = cuts.in_order(10)(region, key)[order]
    assert (np.diff(ranks) >= 0).all() and len(np.unique(ranks)) == 10 and np.bincount(ranks).max() <= 110
    # Regions that the sample has not are parts of their own.
    assert set(cuts.in_regions(20)(np.array([9, 9]), np.array([0.0, 1.0])).tolist()) == {9 << 16}


def test_registered_projection_tree_against_brute_force(spark):
    from feedworks.llm.queries import QUERIES

    place = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{place}/embeddings.parquet").collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float)
    df = QUERIES["op8_projection_tree"](spark, place)
    assert df.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    got, want = lists(df), brute(ids, x, 20, ids % 20 == 0)
    hits = sum(len({i for i, _ in want[q]} & {i for i, _ in got[q]}) for q in want)
    assert got.keys() == want.keys() and hits >= 0.9 * sum(map(len, want.values()))
    for q, found in got.items():
        assert len(found) == 20
        for i, s in found:
            assert s == pytest.approx(float(x[ids == q][0] @ x[ids == i][0]), abs=1e-12)
