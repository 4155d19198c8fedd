"""All clients' clean rows to one typed table per entity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from math import ceil

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from feedworks.functions.frames import union_all
from feedworks.functions.values import surrogate_key
from feedworks.sources.entities import CUSTOMERS, TRANSACTIONS, CanonicalEntity

RECENCY_COLUMN = "_silver_refined_ts"

#: A key with more than one row in so many is a hot one. The sketch is off by a fifth of that share at most.
HOT_SHARE = 500
HOT_TRACKED = 5000
#: Rows of one partition behind the shuffle, some 270 MB while they are sorted. More, smaller ones are no gain: beyond 200
#: partitions (``spark.shuffle.sort.bypassMergeThreshold``) map tasks sort what they send, and may spill it.
ROWS_AT_ONCE = 1_000_000
#: Where this many partitions or fewer would do, the session's number is taken.
FEW_PARTITIONS = 4


@dataclass(frozen=True)
class Dealing:
    """How ``keep_latest`` deals rows out: partitions (None: the session's), and the hashes of hot keys."""

    partitions: int | None = None
    hot: Sequence[int] = ()


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the columns of ``schema``: absent ones as typed nulls, the rest cast.

    This is the one place that decides which columns of a feed the curated table knows.
    The cast is strict. Rows here were typed before, so a value that does not fit
    is a mistake in a spec and must not turn into a null unnoticed.
    """
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def union_clients(frames: Sequence[DataFrame], schema: StructType) -> DataFrame:
    """All rows of all frames. Each is conformed first, so types meet as declared."""
    return union_all([conform(df, schema) for df in frames])


def keep_latest(
    df: DataFrame,
    key: str,
    order: str = RECENCY_COLUMN,
    tie_break: Sequence[str] | None = None,
    how: str = "window",
    dealing: Dealing = Dealing(),
) -> DataFrame:
    """One row per ``key``: the latest by ``order``, nulls last.

    Rows of one run share their time, so ties are settled by ``tie_break``, largest
    first (by default every other column), which makes the choice repeatable. Spark
    keeps one row per key in each map task before the shuffle, so a key that holds
    a large part of the input reaches the reducer as one row per map task.

    Rows are grouped by the key and its hash, which is the same grouping but sorts
    on a number first: keys of one client begin alike, and comparing them as text
    is slow.

    ``how="aggregate"`` finds the same rows as the largest struct of a key, columns beyond ``tie_break``
    settling what that leaves open. Every column must have an order then, which maps have not. Rows are compared
    within a key only, not sorted by all columns, so it is the cheaper one unless keys have many rows

    ``how="shuffle"`` compares the same structs, but sorts behind the shuffle only. The other two sort a map task's
    whole split, which spills as soon as a split is larger than the task's memory. Rows are sent as they are,
    except those of the hot keys that ``dealing`` names (``dealing_of`` finds them), which are reduced in
    their map tasks as above. It pays where keys are nearly distinct. Which keys are called hot does not change the rows.
    """
    if tie_break is None:
        tie_break = [c for c in df.columns if c not in (key, order)]
    if how == "aggregate":
        others = [c for c in df.columns if c not in (key, order, *tie_break)]
        best = F.max(F.struct(order, *tie_break, *others)).alias("_latest")
        latest = df.groupBy(F.xxhash64(key).alias("_key_hash"), key).agg(best)
        return latest.select(*[F.col(key) if c == key else F.col("_latest").getField(c).alias(c) for c in df.columns])
    if how == "shuffle":
        is_hot = F.xxhash64(key).isin(*dealing.hot)
        cold = df.filter(~is_hot) if dealing.hot else df
        dealt = cold.repartition(key) if dealing.partitions is None else cold.repartition(dealing.partitions, key)
        # Rows are where their key is, so this one needs no shuffle of its own.
        latest = keep_latest(dealt, key, order, tie_break, "aggregate")
        return latest.unionByName(keep_latest(df.filter(is_hot), key, order, tie_break, "aggregate")) if dealing.hot else latest
    if how != "window":
        raise ValueError(f"how is 'window', 'aggregate' or 'shuffle', not {how!r}")
    latest_first = [F.col(c).desc_nulls_last() for c in (order, *tie_break)]
    window = Window.partitionBy(F.xxhash64(key), key).orderBy(*latest_first)
    return df.withColumn("_recency", F.row_number().over(window)).filter("_recency = 1").drop("_recency")


def dealing_of(rows: DataFrame, key: str) -> Dealing:
    """Runs a job over the keys: partitions in proportion to the rows, and the keys that have too many of them.

    The keys go through a sketch of frequent items, of bounded size per task, so there are ``HOT_SHARE`` hot keys at most.
    """
    found = rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.call_function("approx_top_k", F.xxhash64(key), F.lit(HOT_SHARE), F.lit(HOT_TRACKED)).alias("top"),
    ).first()
    partitions = ceil(found.n / ROWS_AT_ONCE)
    # A few rows are no load on anybody, whatever their share.
    hot = [t["item"] for t in found.top if t["count"] > max(found.n, ROWS_AT_ONCE) / HOT_SHARE]
    return Dealing(partitions if partitions > FEW_PARTITIONS else None, hot)


def keyed_rows(entity: CanonicalEntity, frames: Mapping[str, DataFrame]) -> DataFrame:
    """All clients' rows of ``entity`` with the key that tells them apart."""
    if not frames:
        raise ValueError(f"no client has {entity.name}")
    key, source = next(iter(entity.keys.items()))
    return union_clients(list(frames.values()), entity.schema).select(surrogate_key("client_id", source).alias(key), "*")


def build_gold(entity: CanonicalEntity, frames: Mapping[str, DataFrame], dealing: Dealing | None = None) -> DataFrame:
    """The curated table of ``entity`` from {client id: clean rows}.

    With ``dealing``, see ``keep_latest``, map tasks need not sort what they read.
    """
    rows = keyed_rows(entity, frames)
    name, *others = entity.keys
    other_keys = [surrogate_key("client_id", entity.keys[key]).alias(key) for key in others]
    ties = [c for c in entity.columns if c != RECENCY_COLUMN]
    how = {"how": "aggregate"} if dealing is None else {"how": "shuffle", "dealing": dealing}
    latest = keep_latest(rows, name, tie_break=ties, **how)
    # Keys that point elsewhere follow from kept columns, so they skip the shuffle.
    return latest.select(name, *other_keys, *entity.columns)


def build_gold_customers(silver_dfs: Mapping[str, DataFrame]) -> DataFrame:
    return build_gold(CUSTOMERS, silver_dfs)


def build_gold_transactions(silver_dfs: Mapping[str, DataFrame]) -> DataFrame:
    return build_gold(TRANSACTIONS, silver_dfs)
