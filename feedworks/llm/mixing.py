"""Mixing sources to target weights.

Words are added up per source. Every source gets a share of the target total by its
weight, at most ``ceiling`` times its own size; what exceeds that goes to the others by
weight, until none is above (found in one step: in the order of ceiling to weight the
sources that are full come first). A source's target by its size is its rate; each
document is taken floor(rate) times, and once more if its hash, seeded, falls below the
fraction. The hash is that of the whole row, so that rows which share an id, or have none, draw
apart, and of its number among rows that are equal in every column; reruns agree.

Only SQL functions are used. One row per source is what gets ranked; the documents
themselves are shuffled only if the sources are too many, or their names too long, to be broadcast, and
then salted, so that a source with most of the documents is spread over tasks. Of equal rows a
single one is shuffled per task, with their number.

Null texts have size 0; a null source is a source like the others, ranked last. Sources
without words have target 0 and are not taken. Texts of any length are counted whole. An
empty table gives an empty table. Columns need a text form (``cast`` to string). Columns of the input named like an output are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedworks.llm.common import WORD, free_name, text_or_empty, written

#: Sources, and bytes of their names, up to which the table of rates is broadcast.
BROADCAST_SOURCES, BROADCAST_NAMES = 10_000, 1 << 20
#: Equal rows that one task writes out again, and kinds of equal rows up to which their digests are broadcast.
EQUAL_ROWS, BROADCAST_KINDS = 10_000, 100_000
#: Parts of a source that are joined apart from each other where it is not.
SALTS = 64
#: Name, size, weight and so on of a source, and what is computed of a document.
OUTPUTS = ("size", "source_size", "target", "copies")


def words(text: str = "text") -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.0, ceiling: float = 3.0):
    """One row per source of ``sizes`` (source, size): its source_size and target.

    Sources weigh ``weights`` in turn, by code point with null last. The target total is
    ``share`` of all sizes.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), turn.cast("int") + 1)
    everything = Window.partitionBy()
    fullest = Window.orderBy((F.col("most") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    earlier = fullest.rowsBetween(Window.unboundedPreceding, -1)
    later = fullest.rowsBetween(0, Window.unboundedFollowing)
    left = F.col("total") - F.coalesce(F.sum("most").over(earlier), F.lit(0.0))
    ranked = (
        totals.withColumn("weight", weight)
        .withColumn("most", F.lit(float(ceiling)) * F.col("source_size"))
        .withColumn("total", F.lit(float(share)) * F.sum("source_size").over(everything))
        .withColumn("level", left / F.sum("weight").over(later))
    )
    # The first source whose even share stays under its ceiling sets the level of all that
    # follow. Levels rise up to it and fall after it, so it has the highest.
    open_level = F.max(F.when(F.col("level") * F.col("weight") <= F.col("most"), F.col("level"))).over(everything)
    target = F.least(F.coalesce(open_level * F.col("weight"), F.col("most")), F.col("most"))
    return ranked.select("source", "source_size", target.alias("target"))


#: Between the columns of a row in its digest, and in place of a null.
BETWEEN, NULL = "\u0001", "\u0002"


def row_digest(columns: Sequence[str]) -> Column:
    """A digest of a row: that of its columns' text forms."""
    cells = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(NULL)) for c in columns]
    return F.md5(F.concat_ws(BETWEEN, *cells))


def draw(digest: Column, number: Column, seed: int) -> Column:
    """A number from 0 to 1 by seed, a row's digest and its number among equal rows."""
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), digest, number.cast("string"))), 1, 13)
    return F.conv(digits, 16, 10).cast("long") / F.lit(float(1 << 52))


def numbered(df: DataFrame, digest: str, number: str) -> DataFrame:
    """``df`` with each row's number (from 0) among the rows that have its digest.

    Rows that are alone stay where they are. Of others the digest is counted, one row of each
    kind is kept, and the kind is written out again, numbered, by as many tasks as its count needs.
    """
    kinds = df.groupBy(digest).agg(F.count("*").alias("equals")).where("equals > 1").select(digest)
    kinds = written(kinds, "mix-equals")
    if kinds.isEmpty():
        return df.withColumn(number, F.lit(0).cast("long"))
    if kinds.limit(BROADCAST_KINDS + 1).count() <= BROADCAST_KINDS:
        kinds = F.broadcast(kinds)
    alone = df.join(kinds, digest, "left_anti").withColumn(number, F.lit(0).cast("long"))
    kept = df.select(digest, F.struct(*df.columns).alias("mix_kept")).join(kinds, digest, "left_semi")
    kept = kept.groupBy(digest).agg(F.count("*").alias("equals"), F.any_value("mix_kept").alias("mix_kept"))
    # Parts are dealt out before they are written out row by row.
    last = F.ceil(F.col("equals") / EQUAL_ROWS) - 1
    parts = kept.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), last))).repartition(digest, "part")
    first = F.col("part") * EQUAL_ROWS
    numbers = F.sequence(first, F.least(first + EQUAL_ROWS, F.col("equals")) - 1)
    equals = parts.select("mix_kept", F.explode(numbers).alias(number)).select("mix_kept.*", number)
    return alone.unionByName(equals)


def mix_plan(
    df: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.0,
    ceiling: float = 3.0,
    seed: int = 0,
    text: str = "text",
    source: str = "source",
    digest: str | None = None,
) -> DataFrame:
    """``df`` with each document's size, its source's size and target, and its copies.

    ``digest`` names a column that tells rows apart, by default that is the digest of all columns.
    """
    if digest is None:
        digest = free_name(df, "mix_digest")
        df = df.withColumn(digest, row_digest(df.columns))
    number = free_name(df, "mix_number")
    size = words(text)
    sizes = df.select(F.col(source).alias("source"), size.alias("size"))
    rates = written(source_targets(sizes, weights, share, ceiling), "mix-rates")
    key, salt = free_name(df, "mix_source"), free_name(df, "mix_salt")
    rates = rates.withColumnRenamed("source", key)
    docs = numbered(df, digest, number)
    docs = docs.drop(*(c for c in df.columns if c.lower() in OUTPUTS and c not in (text, source))).withColumn("size", size)
    few = rates.limit(BROADCAST_SOURCES + 1).agg(F.count("*").alias("n"), F.sum(F.octet_length(key)).alias("bytes")).first()
    if few["n"] <= BROADCAST_SOURCES and (few["bytes"] or 0) <= BROADCAST_NAMES:
        joined = docs.join(F.broadcast(rates), docs[source].eqNullSafe(rates[key]), "left")
    else:
        docs = docs.withColumn(salt, F.pmod(F.xxhash64(digest, number), F.lit(SALTS)))
        rates = rates.withColumn(salt, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        same = docs[source].eqNullSafe(rates[key]) & (docs[salt] == rates[salt])
        joined = docs.join(rates, same, "left").drop(docs[salt], rates[salt])
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(rate)
    copies = whole + F.when(draw(F.col(digest), F.col(number), seed) < rate - whole, 1).otherwise(0)
    return joined.withColumn("copies", copies.cast("long")).drop(key, digest, number)


def mix(df: DataFrame, **settings) -> DataFrame:
    """The mixture: the rows of ``df``, each as often as it is taken, in its own columns."""
    text, source = (settings.get(k, k) for k in ("text", "source"))
    # All columns travel as one, so that none can clash with the plan's.
    rows = df.select(F.struct(*df.columns).alias("mix_row"), text, source, row_digest(df.columns).alias("mix_digest"))
    plan = mix_plan(rows, **settings, digest="mix_digest").where("copies > 0").select("mix_row", "copies")
    times = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return plan.select("mix_row", times.alias("mix_copy")).select("mix_row.*")
