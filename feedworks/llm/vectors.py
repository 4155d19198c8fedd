"""Vectors as rows of matrices: what the two searches share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedworks.llm.common import written


def finite_vectors(df: DataFrame, vec_id: str, vector: str, is_query: Column) -> DataFrame:
    """Rows (vec_id, v, query_row) whose vector has components, all of them finite.

    Null ids take no part; rows that repeat an id do, each by itself.
    """
    v = F.col("v")
    named = df.select(
        F.col(vec_id).alias("vec_id"),
        F.col(vector).cast("array<double>").alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("query_row"),
    )
    return named.where(
        F.col("vec_id").isNotNull()
        & v.isNotNull()
        & (F.size(v) > 0)
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    )


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as a matrix; shorter vectors end in zeros, which change no product."""
    ends = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)
    lengths = np.diff(ends)
    if len(column) and (lengths == width).all():
        return values[ends[0] : ends[-1]].reshape(len(column), width).astype(float)
    out = np.zeros((len(column), width))
    for i, (a, b) in enumerate(zip(ends, ends[1:])):
        out[i, : b - a] = values[a:b]
    return out


def lifted(x: np.ndarray, longest: float) -> np.ndarray:
    """Vectors with one more component that makes them all as long as the longest.

    Among such vectors the largest inner product with a query (whose own extra component is
    0) is the smallest distance from it, which is what an index by distances needs.
    """
    rest = np.sqrt(np.maximum(longest * longest - (x * x).sum(axis=1), 0))
    return np.concatenate((x, rest[:, None]), axis=1)


#: Rows of an index block, and queries that are worked on together.
BLOCK, QUERIES = 4096, 1024
#: Classes an index is fitted on, the ones with the smallest hashes; all are indexed.
SAMPLE = 4096
#: Query blocks that one task compares with a block; blocks that the first round takes, and how many times as many the next.
MEET, FIRST, GROWTH = 32, 8, 8

class Index:
    """Regions of the space, and an order within each; made for ``Search`` by its subclasses."""

    longest: float

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Region and key of each (lifted) vector."""
        raise NotImplementedError

    def reach(self, q: np.ndarray, least: np.ndarray) -> np.ndarray:
        """How far from a query, by the index's own distance, a score of ``least`` can be."""
        raise NotImplementedError

    def wanted(self, q: np.ndarray, reach: np.ndarray) -> Iterator[tuple[int, float, float, float, float]]:
        """Regions, with the keys of the queries and the keys in reach of any of them."""
        raise NotImplementedError

    def needed(self, q: np.ndarray, reach: np.ndarray, x: np.ndarray, region: int) -> np.ndarray:
        """Which vectors of a block each query must verify (one column if all or none)."""
        raise NotImplementedError

    def distance(self, q: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The distance, among lifted vectors, that an inner product of ``least`` means.

        The lowest score stands for none yet, whose distance has no limit.
        """
        if np.issubdtype(least.dtype, np.integer):
            least = np.where(least == np.iinfo(least.dtype).min, -np.inf, least.astype(float))
        square = (q * q).sum(axis=1) + self.longest**2 - 2 * least
        return np.sqrt(np.maximum(square, 0)) * (1 + 1e-9) + 1e-9 * (1 + self.longest)


def flat(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x).tobytes()


NO_ID = np.iinfo(np.int64).max


def best_rows(scores: np.ndarray, good: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """Of one query, the best ``k`` rows of the classes that are ``good``, ties to smaller ids.

    They are told by class, place among its ids, id and score.
    """
    at = np.flatnonzero(good)
    if len(at) > k:  # every class has a row, the one with its first id being the best
        at = at[np.lexsort((ids[at, 0], -scores[at]))[:k]]
    each = ids[at]
    owner, place = np.nonzero(each != NO_ID)
    row_ids, row_scores = each[owner, place], scores[at[owner]]
    order = np.lexsort((row_ids, -row_scores))[:k]
    return at[owner[order]], place[order], row_ids[order], row_scores[order]


def rows_found(queries: int, parts: list[tuple[np.ndarray, ...]], kind: type) -> pa.Table:
    """Rows (block of queries, class that asks, class found, place, vec_id, score) from their parts."""
    none = tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.int64, kind))
    columns = [pa.array(np.concatenate(c)) for c in zip(none, *parts)]
    block = pa.array(np.full(len(columns[0]), queries, np.int64))
    return pa.table([block, *columns], ["queries", "class", "of", "place", "vec_id", "score"])


class Cuts:
    """Where to cut what is sorted by region and key into even parts, by the regions and keys of a sample."""

    def __init__(self, region: np.ndarray, key: np.ndarray):
        order = np.lexsort((key, region))
        self.region, self.key = np.asarray(region)[order], np.asarray(key)[order]

    def in_regions(self, parts: int):
        """The part of each (region, key), about ``parts`` in all and none in two regions."""
        bounds = {}
        for r in np.unique(self.region):
            own = self.key[self.region == r]
            n = min(len(own), max(1, round(parts * len(own) / len(self.key))))
            bounds[int(r)] = np.unique(own[(np.arange(1, n) * len(own)) // n])

        def part(region: np.ndarray, key: np.ndarray) -> np.ndarray:
            out = np.asarray(region, np.int64) << 16
            for r in np.unique(region):
                mine = region == r
                out[mine] += np.searchsorted(bounds.get(int(r), np.empty(0)), key[mine], side="right")
            return out

        return part

    def in_order(self, parts: int):
        """The part of each (region, key), at most ``parts`` in all."""
        n = min(len(self.key), max(1, parts))
        at = (np.arange(1, n) * len(self.key)) // n
        cut_region, cut_key = self.region[at], self.key[at]

        def part(region: np.ndarray, key: np.ndarray) -> np.ndarray:
            out = np.searchsorted(cut_region, region, side="left").astype(np.int64)
            for r in np.unique(region):
                mine = region == r
                out[mine] += np.searchsorted(cut_key[cut_region == r], key[mine], side="right")
            return out

        return part


def _in_blocks(rows: DataFrame, segment: str, block: str, most: int) -> DataFrame:
    """``rows`` with the number of their block: their segment, in parts of about ``most`` rows.

    A segment is one of a bounded number, so that their counts are few rows.
    """
    parts = rows.groupBy(segment).agg(F.ceil(F.count("*") / most).alias("parts"))
    number = F.shiftleft(F.col(segment), 24) + F.pmod(F.xxhash64("class"), F.col("parts"))
    return rows.join(F.broadcast(parts), segment).withColumn(block, number).drop("parts")


def id_matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Lists of at most ``width`` ids as a matrix, with ``NO_ID`` behind them."""
    ids = np.full((len(lists), width), NO_ID)
    ids[np.arange(width) < np.diff(lists.offsets.to_numpy())[:, None]] = lists.flatten().to_numpy()
    return ids


def search(df: DataFrame, k: int, is_query: Column, vec_id: str, vector: str, fit, kind: type) -> DataFrame:
    """Each query's ``k`` best rows (query_id, rank, vec_id, score) by an index.

    Equal vectors are one class: it is searched for once, and found with its smallest ``k + 1``
    ids, which is all that any query can take from it; a query then leaves its own row out.

    ``fit`` makes an ``Index`` of a sample of lifted vectors and the greatest length. All
    classes are put in the order of the index and cut into blocks, where the sample says; so are the classes that ask. A query is
    first compared with the sample, which bounds its last score
    from below; that bound then says which blocks can matter. They are gone through in rounds,
    nearest first and ever more at a time, and what a round finds raises the bound for the next.
    Blocks of queries are sent to the blocks of the index, a few to a task, and
    only rows that are no worse than the bound come back, ``k + 1`` at most from a block: how
    many depends neither on the number of partitions nor on how often a vector is repeated.
    """
    spark, top = df.sparkSession, k + 1
    score_type = "long" if kind is np.int64 else "double"
    rows = written(finite_vectors(df, vec_id, vector, is_query), "vectors")
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    width, longest = rows.agg(F.max(F.size("v")), F.sqrt(F.max(square))).first()
    if width is None:
        return spark.createDataFrame([], f"query_id long, rank int, vec_id long, score {score_type}")
    first_ids = Window.partitionBy("v").orderBy("vec_id")
    few = rows.select("v", "vec_id").withColumn("place", F.row_number().over(first_ids)).where(F.col("place") <= top)
    classes = few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    asking = rows.where("query_row").select("v").distinct().withColumn("asks", F.lit(True))
    classes = written(
        classes.join(asking, "v", "left").select(F.monotonically_increasing_id().alias("class"), "v", "ids", "asks"),
        "vector-classes",
    )
    picked = classes.orderBy(F.xxhash64("v"), "class").limit(SAMPLE).select("class", "v", "ids").toArrow().combine_chunks()
    sample, sample_ids = matrix(picked.column("v").chunk(0), width), id_matrix(picked.column("ids").chunk(0), top)
    sample_names = picked.column("class").to_numpy()
    index: Index = fit(lifted(sample, longest), longest)

    def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
        if kind is np.int64 and longest * longest >= 2**53:
            return q.astype(np.int64) @ x.astype(np.int64).T
        return (q @ x.T).astype(kind)

    lowest = np.iinfo(np.int64).min if kind is np.int64 else -np.inf

    cuts, total = Cuts(*index.place(lifted(sample, longest))), classes.count()
    asks = classes.where("asks").count()
    block_cuts, query_cuts = cuts.in_regions(-(-total // BLOCK)), cuts.in_order(-(-asks // QUERIES))

    def place(batches):
        for batch in batches:
            region, key = index.place(lifted(matrix(batch.column("v"), width), longest))
            columns = [
                pa.array(region, pa.int32()),
                pa.array(key, pa.float64()),
                pa.array(block_cuts(region, key)),
                pa.array(query_cuts(region, key)),
                *batch.columns,
            ]
            yield pa.record_batch(columns, ["region", "key", "segment", "asking", *batch.schema.names])

    placed_schema = "region int, key double, segment long, asking long, class long, v array<double>, ids array<long>, asks boolean"
    placed = written(classes.mapInArrow(place, placed_schema), "placed")

    def pack(key, table):
        keys = table.column("key").to_numpy()
        ids = id_matrix(table.column("ids").combine_chunks(), top)
        data = matrix(table.column("v").combine_chunks(), width)
        columns = [
            pa.array([key[0].as_py()]),
            pa.array([table.column("region")[0].as_py()], pa.int32()),
            pa.array([keys.min()]),
            pa.array([keys.max()]),
            *(pa.array([flat(a)], pa.binary()) for a in (table.column("class").to_numpy(), ids, data)),
        ]
        return pa.table(columns, ["block", "region", "lo", "hi", "classes", "ids", "data"])

    def pack_queries(key, table):
        q = matrix(table.column("v").combine_chunks(), width)
        bounds = (np.full(len(q), lowest, kind), np.full(len(q), NO_ID))
        columns = [pa.array([flat(a)], pa.binary()) for a in (table.column("class").to_numpy(), q, *bounds)]
        return pa.table([pa.array([key[0].as_py()]), *columns, pa.array([[]], WANTED)], ASKED)

    blocks = written(
        _in_blocks(placed, "segment", "block", BLOCK).groupBy("block").applyInArrow(
            pack, "block long, region int, lo double, hi double, classes binary, ids binary, data binary"
        ),
        "index-blocks",
    )
    want = "array<struct<region:int,from_key:double,to_key:double,near:double,far:double>>"
    asked_schema = f"queries long, asking binary, query_data binary, least binary, least_id binary, wanted {want}"
    asked = written(
        _in_blocks(placed.where("asks"), "asking", "queries", QUERIES).groupBy("queries").applyInArrow(
            pack_queries, asked_schema
        ),
        "query-blocks",
    )
    found_schema = f"queries long, class long, of long, place long, vec_id long, score {score_type}"

    def compare_sample(batches):
        every = np.ones(len(sample), bool)
        for batch in batches:
            for row in batch.to_pylist():
                asking = np.frombuffer(row["asking"], np.int64)
                scores = products(np.frombuffer(row["query_data"]).reshape(len(asking), width), sample)
                out = []
                for who, own in zip(asking, scores):
                    of, *found = best_rows(own, every, sample_ids, top)
                    out.append((np.full(len(of), who), sample_names[of], *found))
                yield from rows_found(row["queries"], out, kind).to_batches()

    def compare(key, left, right):
        block = left.to_pylist()[0]
        names = np.frombuffer(block["classes"], np.int64)
        x = np.frombuffer(block["data"]).reshape(len(names), width)
        ids = np.frombuffer(block["ids"], np.int64).reshape(len(names), top)
        raised = lifted(x, longest)
        parts = []
        for batch in right.to_batches(max_chunksize=1):
            row, out = batch.to_pylist()[0], []
            asking = np.frombuffer(row["asking"], np.int64)
            q = np.frombuffer(row["query_data"]).reshape(len(asking), width)
            least, least_id = np.frombuffer(row["least"], kind), np.frombuffer(row["least_id"], np.int64)
            needed = index.needed(q, index.reach(q, least), raised, block["region"])
            at = np.flatnonzero(needed.any(axis=1))
            if not len(at):
                continue
            scores = products(q[at], x)
            # The same product can differ in its last bits from one block to another.
            bound = least[at] if kind is np.int64 else least[at] - 1e-9 * (1 + abs(np.maximum(least[at], -1e300)))
            good = needed[at] & (scores >= bound[:, None])
            for i in np.flatnonzero(good.any(axis=1)).tolist():
                of, place, row_ids, row_scores = best_rows(scores[i], good[i], ids, top)
                if kind is np.int64:
                    kept = (row_scores > bound[i]) | (row_ids <= least_id[at[i]])
                    of, place, row_ids, row_scores = of[kept], place[kept], row_ids[kept], row_scores[kept]
                out.append((np.full(len(of), asking[at[i]]), names[of], place, row_ids, row_scores))
            parts.append(rows_found(row["queries"], out, kind))
        return pa.concat_tables([rows_found(0, [], kind), *parts])

    def met(pairs: DataFrame, asking: DataFrame) -> DataFrame:
        # A block goes to as many tasks as its queries need, MEET blocks of queries to each.
        parts = pairs.groupBy("block").agg(F.ceil(F.count("*") / MEET).alias("parts"))
        heavy = pairs.join(parts, "block").select("queries", "block", F.pmod(F.hash("queries"), "parts").alias("part"))
        heavy = heavy.join(asking.drop("wanted"), "queries")
        copies = blocks.select("block", "region", "classes", "ids", "data").join(parts, "block")
        copies = copies.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).drop("parts")
        both = copies.groupBy("block", "part").cogroup(heavy.groupBy("block", "part"))
        return both.applyInArrow(compare, found_schema)

    def pairs_of(asking: DataFrame) -> DataFrame:
        w = asking.select("queries", F.explode("wanted").alias("w")).select("queries", "w.*")
        b = blocks.select("block", "region", "lo", "hi")
        gap = F.greatest(F.lit(0.0), F.col("near") - F.col("hi"), F.col("lo") - F.col("far"))
        return w.join(b, "region").where("hi >= from_key and lo <= to_key").select("queries", "block", gap.alias("gap"))

    def widen(key, left, right):
        # One block of queries with the bounds that were found for them.
        row = left.to_pylist()[0]
        asking = np.frombuffer(row["asking"], np.int64)
        q = np.frombuffer(row["query_data"]).reshape(len(asking), width)
        least, least_id = np.frombuffer(row["least"], kind).copy(), np.frombuffer(row["least_id"], np.int64).copy()
        place = {n: i for i, n in enumerate(asking.tolist())}
        for n, score, last in zip(*(right.column(c).to_pylist() for c in ("class", "score", "vec_id"))):
            i = place[n]
            if score > least[i] or (score == least[i] and last < least_id[i]):
                least[i], least_id[i] = score, last
        wanted = [
            dict(zip(("region", "from_key", "to_key", "near", "far"), w)) for w in index.wanted(q, index.reach(q, least))
        ]
        columns = [pa.array([flat(a)], pa.binary()) for a in (least, least_id)]
        return pa.table([*(left.column(i) for i in range(3)), *columns, pa.array([wanted], WANTED)], ASKED)

    best = written(asked.select("queries", "asking", "query_data").mapInArrow(compare_sample, found_schema), "search-found")
    met_before, size = None, FIRST
    while True:
        # With ``k + 1`` rows found, the last of them is the bound.
        last = _ranked(best, top).where(F.col("rank") == top).select("queries", "class", "score", "vec_id")
        asked = written(
            asked.groupBy("queries").cogroup(last.groupBy("queries")).applyInArrow(widen, asked_schema), "query-bounds"
        )
        left = pairs_of(asked)
        if met_before is not None:
            left = left.join(met_before, ["queries", "block"], "left_anti")
        left = left.groupBy("queries", "block").agg(F.min("gap").alias("gap"))
        nearest = Window.partitionBy("queries").orderBy("gap", "block")
        left = left.withColumn("place", F.row_number().over(nearest)).where(F.col("place") <= size)
        pairs = written(left.select("queries", "block"), "search-pairs")
        if pairs.isEmpty():
            break
        # A row of the sample is found again in its block.
        found = best.unionByName(met(pairs, asked)).groupBy("queries", "class", "of", "place", "vec_id")
        best = written(_ranked(found.agg(F.max("score").alias("score")), top).drop("rank"), "search-found")
        met_before, size = pairs if met_before is None else met_before.union(pairs), size * GROWTH

    # Every query row leaves itself out: one row of its own class with its own id.
    own = (F.col("of") == F.col("class")).alias("own")
    told = F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score", own))).alias("told")
    lists = written(_ranked(best, top).groupBy("class").agg(told), "search-lists")
    asks = rows.where("query_row").select(F.col("vec_id").alias("query_id"), "v")
    asks = asks.join(classes.where("asks").select("v", "class"), "v").select("query_id", "class").join(lists, "class")
    self_at = F.array_position(F.transform("told", lambda t: t["own"] & (t["vec_id"] == F.col("query_id"))), True)
    others = F.filter("told", lambda t, i: i + 1 != F.col("self_at"))
    kept = asks.withColumn("self_at", self_at).select("query_id", F.posexplode(F.slice(others, 1, k)).alias("at", "t"))
    return kept.select("query_id", (F.col("at") + 1).alias("rank"), F.col("t.vec_id").alias("vec_id"), F.col("t.score").alias("score"))


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` rows of each class that asks, with their rank from 1."""
    best = Window.partitionBy("class").orderBy(F.desc("score"), "vec_id", "of", "place")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


ASKED = ["queries", "asking", "query_data", "least", "least_id", "wanted"]
WANTED = pa.list_(
    pa.struct([("region", pa.int32()), *((n, pa.float64()) for n in ("from_key", "to_key", "near", "far"))])
)
