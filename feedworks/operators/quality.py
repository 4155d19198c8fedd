"""Reports on what was rejected, and on transactions and their customers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedworks.functions.frames import union_all
from feedworks.operators.refine import REASON_COLUMN

Feed = tuple[str, str]


def reason_counts(quarantine: DataFrame) -> DataFrame:
    """Rows per reason of one quarantine table, most frequent first."""
    return quarantine.groupBy(REASON_COLUMN).count().orderBy(F.desc("count"), REASON_COLUMN)


def quarantine_summary(quarantines: Mapping[Feed, DataFrame]) -> DataFrame:
    """Rows per client, entity and reason over {(client id, entity): quarantined rows}."""
    parts = [
        df.select(F.lit(client_id).alias("client_id"), F.lit(entity).alias("entity"), REASON_COLUMN)
        for (client_id, entity), df in quarantines.items()
    ]
    return union_all(parts).groupBy("client_id", "entity", REASON_COLUMN).count()


def top_reasons(summary: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` most frequent lines of a summary, ties in name order."""
    names = [c for c in summary.columns if c != "count"]
    return summary.orderBy(F.desc("count"), *names).limit(n)


def row_balance(
    raw: Mapping[Feed, DataFrame], clean: Mapping[Feed, DataFrame], quarantines: Mapping[Feed, DataFrame]
) -> DataFrame:
    """Raw, clean and quarantined row counts per feed; raw is the sum of the others."""
    stages = {"bronze_n": raw, "clean_n": clean, "quarantine_n": quarantines}
    parts = [
        df.select(F.lit(client_id).alias("client_id"), F.lit(entity).alias("entity"), F.lit(stage).alias("stage"))
        for stage, frames in stages.items()
        for (client_id, entity), df in frames.items()
    ]
    counts = {stage: F.count_if(F.col("stage") == stage).alias(stage) for stage in stages}
    return union_all(parts).groupBy("client_id", "entity").agg(*counts.values())


def enrich_transactions(
    transactions: DataFrame, customers: DataFrame, customer_columns: Sequence[str] | None = None
) -> DataFrame:
    """Every transaction with its customer's columns, null where none joins.

    A customer column whose name a transaction has too (in any case) gets the prefix
    ``customer_``, again for as long as a transaction or another customer column has that name as well. The join
    strategy is left to Spark: it broadcasts customers only
    if their measured size allows it and splits skewed customers otherwise.
    """
    if customer_columns is None:
        customer_columns = [c for c in customers.columns if c != "customer_key"]
    taken = {c.lower() for c in transactions.columns}
    renamed = [c for c in customer_columns if c.lower() in taken]
    taken |= {c.lower() for c in customer_columns}
    names = {}
    for column in renamed:
        name = f"customer_{column.lstrip('_')}"
        while name.lower() in taken:
            name = f"customer_{name}"
        names[column] = name
        taken.add(name.lower())
    named = [F.col(c).alias(names.get(c, c)) for c in customer_columns]
    return transactions.join(customers.select("customer_key", *named), "customer_key", "left")


def orphan_transactions(transactions: DataFrame, customers: DataFrame) -> DataFrame:
    """Transactions per client that join to no customer.

    Transactions are counted per customer first, so only one row per customer is
    joined, whatever share of all transactions one customer has. Counts and join have
    the same key, so transactions are shuffled once.
    """
    per_customer = transactions.groupBy("client_id", "customer_key").agg(F.count(F.lit(1)).alias("n"))
    unmatched = per_customer.join(customers.select("client_id", "customer_key"), ["client_id", "customer_key"], "left_anti")
    return unmatched.groupBy("client_id").agg(F.sum("n").alias("n"))
