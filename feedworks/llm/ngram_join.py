"""N-gram Jaccard join: all texts whose sets of word shingles are alike.

Two texts are linked if the Jaccard similarity of their sets of five-word shingles
is at least the threshold. The join runs in these steps, each a Spark job:

1. Texts become sets of hashed shingles and MinHash signatures (numpy, per Arrow batch).
   Texts with equal sets are one class, however many copies there are.
2. LSH forest: the signature has ``TREES`` parts of ``DEPTH`` values; each part is a
   path in a tree. A tree's paths are sorted, so that classes below one node are neighbours.
   Each class is tied to its neighbour, with which it shares the longest prefix: matched
   prefixes may be as short as the length at which a pair at the threshold is missed
   by all trees with a probability below ``1 - recall``. Ties are chains, never all pairs
   of a node. Classes tied together are one cluster.
3. Exact verification inside clusters: all pairs of a cluster are compared, as products of
   0/1 matrices. A cluster of more than ``BLOCK`` classes is dealt out as
   pairs of blocks. Links are counted where they are found, never written out;
   what leaves a task are counts and a forest of at most one link per class.
4. The links' connected components are the groups.

Words are runs of characters other than space and tab to return, taken as written. A text of
one to four words has one shingle, of all its words; texts without any word, null
ones included, have none and are linked to nothing. Repeated ids count as
separate rows but share a result if their texts do; null ids are rows as well and never stand
for a group unless all of it is null. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import log

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedworks.llm.common import WORD, free_name, slices, text_or_empty, written
from feedworks.llm.components import connected_components
from feedworks.llm.hashing import mixed, word_hashes

SHINGLE = 5
TREES, DEPTH = 32, 8
BLOCK = 512
#: Shingles that a block may have on average before a cluster gets more blocks.
BLOCK_SHINGLES = 500_000
#: Classes or ids, without texts, up to which they are broadcast to the documents.
BROADCAST_MEMBERS = 200_000
U = np.uint64
TIES = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("at", pa.int32()), ("first", pa.binary()), ("last", pa.binary())])


@lru_cache(maxsize=1)
def functions(count: int = TREES * DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers and offsets of the MinHash functions, the same everywhere."""
    numbers = mixed(np.arange(1, 2 * count + 1, dtype=U) * U(0xD1342543DE82EF95))
    return (numbers[:count] >> U(32)).astype(np.uint32) | np.uint32(1), (numbers[count:] >> U(32)).astype(np.uint32)


def shingle_set(text: bytes) -> np.ndarray:
    """The sorted hashes of a text's distinct shingles."""
    words = word_hashes(np.frombuffer(text, np.uint8))
    if not len(words):
        return words
    n = min(SHINGLE, len(words))
    total = np.zeros(len(words) - n + 1, U)
    for k in range(n):
        total = total * U(0xD6E8FEB86659FD93) + words[k : len(words) - n + 1 + k]
    return np.unique(mixed(total + U(n)))


def signature(shingles: np.ndarray) -> bytes:
    """MinHash values, 16 bits each, tree by tree."""
    times, plus = functions()
    low = np.full(len(times), 0xFFFFFFFF, np.uint32)
    short = (shingles >> U(32)).astype(np.uint32)
    for at in range(0, len(short), 512):  # small enough to stay in the cache
        low = np.minimum(low, (short[at : at + 512, None] * times + plus).min(axis=0))
    return (low >> np.uint32(16)).astype(">u2").tobytes()


def set_marks(shingles: np.ndarray) -> tuple[int, int]:
    """Two sums of a set's hashes, which tell sets apart: 128 bits, whatever the order."""
    sums = (np.add.reduce(mixed(shingles ^ U(key))) for key in (0, 0xA0761D6478BD642F))
    return tuple(int(np.asarray(x, U).view(np.int64)) for x in sums)


def signatures(rows: DataFrame) -> DataFrame:
    """Rows (doc_id, text, text_mark) as doc_id, text_mark, the marks of the text's shingle set, its size and its paths."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (part for batch in batches for part in slices(batch)):
            sets = [shingle_set(text) for text in part.column("text").cast(pa.binary()).to_pylist()]
            marks = [set_marks(found) for found in sets]
            paths = [signature(found) if len(found) else b"" for found in sets]
            yield pa.record_batch(
                [
                    part.column("doc_id"),
                    part.column("text_mark"),
                    pa.array([m[0] for m in marks], pa.int64()),
                    pa.array([m[1] for m in marks], pa.int64()),
                    pa.array([len(found) for found in sets], pa.int32()),
                    pa.array(paths, pa.binary()),
                ],
                ["doc_id", "text_mark", "high", "low", "shingles", "paths"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(sign, f"doc_id {kind}, text_mark long, high long, low long, shingles int, paths binary")


def prefix_length(threshold: float, recall: float, trees: int = TREES, depth: int = DEPTH) -> int:
    """The longest prefix with which a pair at the threshold is found with that probability."""
    for length in range(depth, 1, -1):
        if trees * log(1 - threshold**length) <= log(1 - recall):
            return length
    return 1


def forest_ties(classes: DataFrame, shortest: int) -> DataFrame:
    """Ties (a, b) between classes (``class_no``, ``paths``) that share a node of some tree.

    All trees' paths are sorted over range partitions, which split even a node that holds
    most of the classes. Neighbours in that order part as deep in the tree as any two classes
    do, so each is tied to the one before it if their common prefix is long enough.
    The neighbours on two sides of a partition's end are tied afterwards.
    """
    width, size = 2 * DEPTH, 2 * shortest

    def ties(batches):
        # One partition, in order: its ties, then its first and last class.
        last = None
        first = None
        for batch in batches:
            tree = batch.column("tree").to_numpy()
            number = batch.column("class_no").to_numpy()
            path = np.frombuffer(b"".join(batch.column("path").to_pylist()), np.uint8).reshape(len(number), width)
            node = np.concatenate((tree.astype(np.uint8)[:, None], path[:, :size]), axis=1)
            if first is None:
                first = (node[0].tobytes(), number[0])
            if last is not None:
                node = np.concatenate((np.frombuffer(last[0], np.uint8)[None, :], node))
                number = np.concatenate(([last[1]], number))
            same = (node[1:] == node[:-1]).all(axis=1)
            last = (node[-1].tobytes(), number[-1])
            found = int(same.sum())
            yield pa.record_batch(
                [pa.array(number[:-1][same]), pa.array(number[1:][same]), pa.nulls(found, pa.int32()),
                 pa.nulls(found, pa.binary()), pa.nulls(found, pa.binary())],
                TIES.names,
            )
        if first is not None:
            at = TaskContext.get().partitionId()
            yield pa.record_batch(
                [pa.array([first[1]]), pa.array([last[1]]), pa.array([at], pa.int32()),
                 pa.array([first[0]], pa.binary()), pa.array([last[0]], pa.binary())],
                TIES.names,
            )

    tree = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")
    rows = classes.select("class_no", "paths", tree).select(
        "tree", F.expr(f"substring(paths, tree * {width} + 1, {width})").alias("path"), "class_no"
    )
    order = ["tree", "path", "class_no"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    found = written(ranged.mapInArrow(ties, "a long, b long, at int, first binary, last binary"), "forest-ties")
    # One row per partition: the last class of one meets the first of the next that has any.
    ends = Window.orderBy("at")
    between = (
        found.where("at is not null")
        .select("a", F.lag("b").over(ends).alias("b"), "first", F.lag("last").over(ends).alias("before"))
        .where("first = before")
        .select("a", "b")
    )
    return found.where("at is null").select("a", "b").unionByName(between).distinct()


def compare_blocks(pdf: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links of one pair of blocks: a forest of them, and what each class gains by all."""
    one = pdf["i"].iat[0] == pdf["j"].iat[0]
    number = pdf["class_no"].to_numpy()
    copies = pdf["copies"].to_numpy()
    side = pdf["side"].to_numpy()
    sets = [np.frombuffer(x, U) for x in pdf["hashes"]]
    sizes = np.array([len(s) for s in sets])
    every, column = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    # Only shingles that several classes have can be common to two.
    count = np.bincount(column, minlength=len(every))
    kept = count[column] > 1
    place = np.cumsum(count > 1) - 1
    column, owner = place[column[kept]], owner[kept]
    width = int((count > 1).sum())
    rows, cols = np.flatnonzero(side == 0), np.flatnonzero(side == (0 if one else 1))
    common = np.zeros((len(rows), len(cols)), np.float32)
    at_row, at_col = np.full(len(sets), -1), np.full(len(sets), -1)
    at_row[rows], at_col[cols] = np.arange(len(rows)), np.arange(len(cols))
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    step = 4096
    for start in range(0, width, step):  # a strip of columns at a time bounds memory
        lo, hi = np.searchsorted(column, [start, start + step])
        c, o = column[lo:hi] - start, owner[lo:hi]
        left = np.zeros((len(rows), step), np.float32)
        mine = at_row[o] >= 0
        left[at_row[o[mine]], c[mine]] = 1
        if one:
            right = left
        else:
            right = np.zeros((len(cols), step), np.float32)
            mine = at_col[o] >= 0
            right[at_col[o[mine]], c[mine]] = 1
        common += left @ right.T
    either = sizes[rows][:, None] + sizes[cols][None, :] - common
    linked = common >= threshold * either - 1e-6
    if one:
        np.fill_diagonal(linked, False)
    gains = np.zeros(len(sets), np.int64)
    gains[rows] += linked @ copies[cols]
    if not one:
        gains[cols] += copies[rows] @ linked
    # A forest over the links: each class takes its first partner, then trees are joined.
    parent = np.arange(len(sets))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links = []
    for r in range(len(rows)):
        partners = cols[linked[r]]
        _, one_each = np.unique(parent[partners], return_index=True)
        for c in partners[one_each]:
            x, y = root(rows[r]), root(c)
            if x != y:
                parent[max(x, y)] = min(x, y)
                links.append((number[rows[r]], number[c]))
        parent[partners] = root(rows[r])
    gained = np.flatnonzero(gains)
    a = [x for x, _ in links] + number[gained].tolist()
    b = [y for _, y in links] + [-1] * len(gained)
    return pd.DataFrame({"a": a, "b": b, "gain": [0] * len(links) + gains[gained].tolist()}, dtype=np.int64)


def jaccard_links(
    df: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = 0.8, recall: float = 0.99999
) -> DataFrame:
    """One row per row of ``df``: its id, its ``class_id`` and ``n_links``.

    ``class_id`` is the smallest id of its group, the texts that links connect to it
    (itself included); ``n_links`` counts the other rows with a similarity at or above
    ``threshold``, copies of its own text among them.
    """
    signed, known = linked_classes(df, text, doc_id, threshold, recall)
    links = told_rows(signed, known).select("doc_id", "class_id", "n_links")
    return links.withColumnRenamed("doc_id", doc_id)


def linked_classes(df: DataFrame, text: str, doc_id: str, threshold: float, recall: float) -> tuple[DataFrame, DataFrame]:
    """The signed rows, and for each class of equal sets (high, low) what is known of it.

    That is its ``first_id``, ``class_id`` and ``n_links``, and whether it is ``chosen`` to stand
    for its group: the class of the smallest id (nulls last), then of the smallest marks (high, low).
    """
    rows = df.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text"))
    rows = rows.withColumn("text_mark", F.xxhash64("text"))
    signed = written(signatures(rows), "shingle-signatures")
    told = signed.where("shingles > 0")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_mark")).alias("first")
    classes = told.groupBy("high", "low").agg(
        first, F.count("*").alias("copies"), F.first("shingles").alias("shingles"), F.first("paths").alias("paths")
    )
    # Numbers are distinct, and what is written once keeps its own; no result depends on which it is.
    classes = classes.select(
        "high",
        "low",
        F.col("first.doc_id").alias("first_id"),
        F.col("first.text_mark").alias("first_text"),
        "copies",
        "shingles",
        "paths",
        F.monotonically_increasing_id().alias("class_no"),
    )
    classes = written(classes, "shingle-classes")
    clusters = connected_components(forest_ties(classes, prefix_length(threshold, recall)))

    members = clusters.withColumnRenamed("node", "class_no").join(classes.drop("paths"), "class_no")
    sizes = members.groupBy("component").agg(F.count("*").alias("n"), F.sum("shingles").alias("total"))
    blocks = F.ceil(F.greatest(F.col("n") / BLOCK, F.col("total") / BLOCK_SHINGLES)).cast("int").alias("blocks")
    members = written(members.join(sizes.select("component", blocks), "component"), "cluster-members")
    block = F.pmod(F.xxhash64("class_no", F.lit(1)), F.col("blocks")).cast("int")
    placed = member_sets(rows, members).withColumn("block", block)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = placed.withColumn("other", other).select(
        "component",
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
        F.when(F.col("block") <= F.col("other"), 0).otherwise(1).alias("side"),
        "class_no",
        "copies",
        "hashes",
    )

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        return compare_blocks(pdf, threshold)

    found = written(
        dealt.groupBy("component", "i", "j").applyInPandas(compare, "a long, b long, gain long"), "verified-links"
    )
    gains = found.where("b = -1").groupBy(F.col("a").alias("class_no")).agg(F.sum("gain").alias("gain"))
    groups = connected_components(found.where("b <> -1").select("a", "b"))
    grouped = groups.withColumnRenamed("node", "class_no").join(classes.select("class_no", "first_id", "high", "low"), "class_no")
    rank = F.struct(F.col("first_id").isNull().alias("unnamed"), "first_id", "high", "low", "class_no")
    firsts = grouped.select("component", rank.alias("rank")).groupBy("component").agg(F.min("rank").alias("first"))
    chosen = F.col("class_no") == F.col("first.class_no")
    grouped = grouped.join(firsts, "component").select(
        "class_no", F.col("first.first_id").alias("group_id"), chosen.alias("chosen")
    )
    known = (
        classes.select("high", "low", "class_no", "first_id", "copies")
        .join(grouped, "class_no", "left")
        .join(gains, "class_no", "left")
        .select(
            "high",
            "low",
            "first_id",
            F.coalesce("group_id", "first_id").alias("class_id"),
            (F.coalesce("gain", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("chosen", F.lit(True)).alias("chosen"),
        )
    )
    return signed, known


def told_rows(signed: DataFrame, known: DataFrame) -> DataFrame:
    """The signed rows' doc_id, class_id, n_links, and whether they may stand for their group (``stays``)."""
    stays = F.col("chosen") & F.col("doc_id").eqNullSafe(F.col("first_id"))
    linked = signed.where("shingles > 0").select("doc_id", "high", "low").join(known, ["high", "low"])
    alone = signed.where("shingles = 0").select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(True).alias("stays")
    )
    return linked.select("doc_id", "class_id", "n_links", stays.alias("stays")).unionByName(alone)


def member_sets(rows: DataFrame, members: DataFrame) -> DataFrame:
    """The members with their shingle sets, from the text of each class's first row.

    A class is asked for by that row's id and text, so a row brings along one class at most, however many
    rows share its id or have none.
    """
    few = members.limit(BROADCAST_MEMBERS + 1).count() <= BROADCAST_MEMBERS
    first = members.select("class_no", "copies", "component", "blocks", "high", "low", "first_id", "first_text")
    same = rows["doc_id"].eqNullSafe(first["first_id"]) & (rows["text_mark"] == first["first_text"])
    found = rows.join(F.broadcast(first) if few else first, same)

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (part for batch in batches for part in slices(batch)):
            sets = [shingle_set(text) for text in part.column("text").cast(pa.binary()).to_pylist()]
            # Two texts of one id can have the same mark by chance: only the class's own set counts.
            marks = zip(part.column("high").to_pylist(), part.column("low").to_pylist())
            own = pa.array([set_marks(s) == m for s, m in zip(sets, marks)], pa.bool_())
            columns = [part.column(c) for c in ("class_no", "copies", "component", "blocks")]
            batch = pa.record_batch(
                [*columns, pa.array([s.tobytes() for s in sets], pa.binary())],
                ["class_no", "copies", "component", "blocks", "hashes"],
            )
            yield batch.filter(own)

    columns = found.select("class_no", "copies", "component", "blocks", "high", "low", "text")
    sets = columns.mapInArrow(hashes, "class_no long, copies long, component long, blocks int, hashes binary")
    return sets.dropDuplicates(["class_no"])


def keep_one_of_each_group(
    df: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = 0.8, recall: float = 0.99999
) -> DataFrame:
    """The rows of ``df`` whose id is the smallest of its group; all their columns stay.

    Ids name documents: rows that repeat the id which stays all stay, and all rows of an id go, null
    ones too, if one of them does. Where ids may be null or repeat with different texts,
    ``keep_one_row_of_each_group`` loses no text.
    """
    links = jaccard_links(df, text, doc_id, threshold, recall)
    key = free_name(df, "kept_id")
    gone = written(links.where(~F.col(doc_id).eqNullSafe(F.col("class_id"))).select(F.col(doc_id).alias(key)).distinct(), "gone")
    few = gone.limit(BROADCAST_MEMBERS + 1).count() <= BROADCAST_MEMBERS
    return df.join(F.broadcast(gone) if few else gone, df[doc_id].eqNullSafe(gone[key]), "left_anti")


def keep_one_row_of_each_group(
    df: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = 0.8, recall: float = 0.99999
) -> DataFrame:
    """One row of ``df`` of each group, and all rows without any word; all their columns stay.

    Rows are told apart by their texts, whatever ids they repeat. The row with the smallest id stays,
    nulls last; among rows that share it, those of the class with the smallest marks, and
    of these the one that comes first by its text and then its other columns.
    """
    signed, known = linked_classes(df, text, doc_id, threshold, recall)
    key = free_name(df, "told_id")
    counts = told_rows(signed, known).groupBy(F.col("doc_id").alias(key)).agg(
        F.count_if(~F.col("stays")).alias("gone"), F.count_if("stays").alias("left")
    )
    counts = written(counts.where("gone > 0 or left > 1"), "told-ids")

    def small(ids: DataFrame) -> DataFrame:
        return F.broadcast(ids) if ids.limit(BROADCAST_MEMBERS + 1).count() <= BROADCAST_MEMBERS else ids

    # No row of these ids stays. Of the others with several rows, the texts are asked again.
    gone = small(counts.where("left = 0").select(key))
    left = df.join(gone, df[doc_id].eqNullSafe(gone[key]), "left_anti")
    mixed = counts.where("left > 0").select(key)
    if mixed.isEmpty():
        return left
    mixed = small(mixed)
    asked = left[doc_id].eqNullSafe(mixed[key]) & text_or_empty(left[text]).rlike(WORD)
    certain = left.join(mixed, asked, "left_anti")
    mark = free_name(df, "set_mark")
    told = left.join(mixed, asked, "left_semi").withColumn(mark, marks_of(text_or_empty(text)))
    standing = known.where("chosen").select(F.struct("high", "low").alias("marks"), "first_id")
    stays = (told[mark] == standing["marks"]) & told[doc_id].eqNullSafe(standing["first_id"])
    told = told.join(standing, stays, "left_semi")
    others = [f.name for f in df.schema.fields if not any(x in f.dataType.simpleString() for x in ("map<", "variant"))]
    best = Window.partitionBy(mark).orderBy(text, *(c for c in others if c not in (text, doc_id)))
    at = free_name(df, "at_in_group")
    one = told.withColumn(at, F.row_number().over(best)).where(F.col(at) == 1).drop(at, mark)
    return certain.unionByName(one)


def marks_of(text: Column) -> Column:
    """The marks (high, low) of a text's shingle set, as in ``signatures``."""

    @F.arrow_udf("struct<high:bigint,low:bigint>")
    def marks(batch: pa.Array) -> pa.Array:
        found = [set_marks(shingle_set(t)) for part in slices(batch) for t in part.cast(pa.binary()).to_pylist()]
        return pa.StructArray.from_arrays([pa.array([m[k] for m in found], pa.int64()) for k in (0, 1)], ["high", "low"])

    return marks(text)
