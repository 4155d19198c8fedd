"""Times the headline queries and prints one JSON line.

Reads ``BENCH_SF_DIR`` (default the sf0.1 tables) on ``local[BENCH_CPUS]``. Every
entry is run ``BENCH_RUNS`` times and its fastest run counts. The ``stage_`` entries
write tables from landed text; the others run a query to its end without keeping
the result. Writing the text feeds is preparation and is not timed.
"""

from __future__ import annotations

import json
import os
import re
import time
from collections.abc import Callable

from pyspark.sql import SparkSession

from checks.messy_feeds import CONFIGS, FEEDS, Landing
from checks.queries import QUERIES
from feedworks.plans import stages
from feedworks.plans.sizing import session_settings

HEADLINE = [
    "bronze_corrupt_capture",
    "bronze_row_counts",
    "rename_null_tokens",
    "split_name",
    "parse_dates",
    "parse_timestamps",
    "cast_int_safe",
    "cast_decimal_clean",
    "map_boolean",
    "quarantine_rows",
    "silver_client_a_transactions",
    "silver_client_b_transactions",
    "silver_client_c_transactions",
    "split_conservation",
    "union_clients",
    "surrogate_keys",
    "dedupe_latest",
    "dedupe_ties",
    "gold_customers",
    "gold_transactions",
    "gold_counts",
    "quarantine_summary",
    "quarantine_top_reasons",
    "transactions_with_customers",
    "orphan_transactions",
]


def folder_bytes(path: str) -> int:
    return sum(entry.stat().st_size for entry in os.scandir(path) if entry.is_file())


def fastest(run: Callable[[], object], times: int) -> float:
    taken = []
    for _ in range(times):
        start = time.perf_counter()
        run()
        taken.append(time.perf_counter() - start)
    return round(min(taken), 4)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    cores = int(cpus) if cpus.isdigit() else os.cpu_count() or 1

    builder = (
        SparkSession.builder.appName("feedworks-bench")
        .master(f"local[{cpus}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
    )
    # The tables are small: all cores are worth more than large partitions.
    for key, value in session_settings(folder_bytes(sf_dir), cores, parallelism_first=True).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    landing = Landing.of(spark, sf_dir)
    landing.write(*FEEDS)
    bronze, silver, gold = (landing.schema(layer) for layer in ("bronze", "silver", "gold"))

    seconds = {
        "stage_ingest": fastest(lambda: stages.run_ingest(spark, CONFIGS, landing.input_dir, bronze), runs),
        "stage_refine": fastest(lambda: stages.run_refine(spark, CONFIGS, bronze, silver), runs),
        "stage_curate": fastest(lambda: stages.run_curate(spark, CONFIGS, silver, gold), runs),
    }
    landing.curate_report()  # the table queries below find every stage done
    for name in HEADLINE:
        seconds[name] = fastest(lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save(), runs)

    landing.close()
    scale = re.search(r"sf([0-9.]+)$", sf_dir)
    report = {
        "metric": "headline_total",
        "value": round(sum(seconds.values()), 4),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale.group(1)) if scale else None,
        "cpus": cores,
        "runs": runs,
    }
    spark.stop()
    print(json.dumps(report))


if __name__ == "__main__":
    main()
