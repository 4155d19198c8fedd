"""

``stages`` runs land, refine and curate the straightforward way and the library's way on
``MEASURE_SF_DIR`` times ``MEASURE_COPIES``; ``keys`` compares even with hot keys, and the
map-side limit with none; ``casts`` times values that fail against values that do not.
"""

from __future__ import annotations

import os
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks.messy_feeds import CONFIGS, FEEDS, Landing, feed_lines, spec, write_feed
from feedworks.functions import values
from feedworks.operators import quality
from feedworks.operators.canonical import build_gold, keep_latest
from feedworks.operators.refine import refine_entity
from feedworks.plans import stages
from feedworks.plans.sizing import session_settings
from feedworks.sources.delimited import read_raw
from feedworks.sources.entities import CANONICAL

RUNS = 2


def session(**settings: str) -> SparkSession:
    builder = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
    builder = builder.config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC")
    for key, value in {**session_settings(1 << 30, 8), **settings}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(run: Callable[[], object], runs: int = RUNS) -> float:
    taken = []
    for _ in range(runs):
        start = time.perf_counter()
        run()
        taken.append(time.perf_counter() - start)
    return round(min(taken), 2)


def discard(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def measure_stages(spark: SparkSession) -> None:
    sf_dir, copies = os.environ.get("MEASURE_SF_DIR", "/root/testdata/sf0.1"), int(os.environ.get("MEASURE_COPIES", "1"))
    landing = Landing.of(spark, sf_dir)
    for client_id, entity in FEEDS:
        feed = spec(client_id, entity)
        lines = feed_lines(spark, sf_dir, client_id, entity)
        lines = lines.crossJoin(F.broadcast(spark.range(copies).select(F.lit(0).alias("copy"))))
        write_feed(lines, feed["columns"], feed["delimiter"], f"{landing.input_dir}/{client_id}/{feed['file']}")
    names = [f"{way}_{layer}" for way in ("plain", "ours") for layer in ("bronze", "silver", "gold")]
    layers = {name: landing.schema(name) for name in names}

    def save(df: DataFrame, name: str) -> int:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        df.write.saveAsTable(name)
        return spark.table(name).count()

    def plain_land() -> None:
        for c, e in FEEDS:
            save(read_raw(spark, c, e, spec(c, e), landing.input_dir), f"{layers['plain_bronze']}.{c}_{e}")

    def plain_refine() -> None:
        for c, e in FEEDS:
            clean, rejected = refine_entity(spark.table(f"{layers['plain_bronze']}.{c}_{e}"), spec(c, e))
            save(clean, f"{layers['plain_silver']}.{c}_{e}")
            save(rejected, f"{layers['plain_silver']}.{c}_{e}_quarantine")

    def plain_curate() -> None:
        for name, entity in CANONICAL.items():
            frames = {c: spark.table(f"{layers['plain_silver']}.{c}_{e}") for c, e in FEEDS if e == name}
            save(build_gold(entity, frames), f"{layers['plain_gold']}.{name}")

    ours = [
        lambda: stages.run_ingest(spark, CONFIGS, landing.input_dir, layers["ours_bronze"]),
        lambda: stages.run_refine(spark, CONFIGS, layers["ours_bronze"], layers["ours_silver"]),
        lambda: stages.run_curate(spark, CONFIGS, layers["ours_silver"], layers["ours_gold"]),
    ]
    for name, plain, own in zip(("land", "refine", "curate"), (plain_land, plain_refine, plain_curate), ours):
        print(f"{name}: plain {seconds(plain)}, ours {seconds(own)}")
    landing.close()


def measure_keys(spark: SparkSession) -> None:
    n = int(os.environ.get("MEASURE_ROWS", "3000000"))

    def rows(key: F.Column) -> DataFrame:
        cells = [F.col("id").cast("string").alias(f"c{i}") for i in range(5)]
        return spark.range(n, numPartitions=16).select(key.alias("key"), (F.col("id") % 1000).alias("ts"), *cells)

    def unlimited(df: DataFrame) -> DataFrame:
        ties = [F.col(c).desc_nulls_last() for c in df.columns if c != "key"]
        best = Window.partitionBy(F.xxhash64("key"), "key").orderBy(*ties)
        # A filter on the rank in disguise keeps Spark from limiting groups before the shuffle.
        return df.withColumn("r", F.row_number().over(best)).filter((F.col("r") + F.col("ts") * 0) == 1).drop("r")

    for name, key in (
        ("distinct keys", F.col("id").cast("string")),
        ("2 rows a key", (F.col("id") % (n // 2)).cast("string")),
        ("30 rows a key", (F.col("id") % (n // 30)).cast("string")),
        ("a third on one key", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))),
    ):
        df, best = rows(key), {}
        ways = {
            "window": lambda df: keep_latest(df, "key", order="ts"),
            "window without map-side limit": unlimited,
            "aggregate": lambda df: keep_latest(df, "key", order="ts", how="aggregate"),
        }
        for _ in range(3):  # in turn, so that a slow moment of the machine meets all
            for way, run in ways.items():
                best[way] = min(seconds(lambda: discard(run(df)), runs=1), best.get(way, 1e9))
        print(f"keep_latest, {name}: {best}")
    for name, key in (("even", F.col("id") % 1_000_000), ("hot", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")))):
        both = F.lit("a").alias("client_id"), key.cast("string").alias("customer_key")
        sales = spark.range(n, numPartitions=16).select(*both, F.concat(F.lit("t"), "id").alias("transaction_key"))
        people = spark.range(n // 3).select(F.lit("a").alias("client_id"), F.col("id").cast("string").alias("customer_key"))
        print(f"orphan_transactions, {name}: {seconds(lambda: discard(quality.orphan_transactions(sales, people)))}")
        print(f"enrich_transactions, {name}: {seconds(lambda: discard(quality.enrich_transactions(sales, people)))}")


def measure_casts(spark: SparkSession) -> None:
    n = int(os.environ.get("MEASURE_ROWS", "3000000"))
    iso = "yyyy-MM-dd"
    builders = {
        "date": (lambda c: values.parse_date(c, iso), "2024-05-06"),
        "timestamp": (lambda c: values.parse_timestamp(c, iso), "2024-05-06"),
        "amount": (values.parse_money, "123.45"),
        "int": (values.parse_int, "12345"),
    }
    for name, (build, good) in builders.items():
        found = []
        for text in (good, "", "unknown", "9-x-9"):
            cell = F.when(F.col("id") >= 0, text)
            df = spark.range(n, numPartitions=8).select(build(cell).alias("v"))
            found.append(f"{text!r} {seconds(lambda: discard(df)) * 8 / n * 1e9:.0f}")
        print(f"{name}, ns per row and core: {', '.join(found)}")


def main(names: list[str]) -> None:
    for name in names or ["stages", "keys", "casts"]:
        more = {"spark.sql.autoBroadcastJoinThreshold": "-1"} if name == "keys" else {}
        spark = session(**more)
        globals()[f"measure_{name}"](spark)
        spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
