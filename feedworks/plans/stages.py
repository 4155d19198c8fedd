"""The three stages over all feeds: land raw text, refine, curate.

A stage reads the tables of the one before and replaces its own, so any of them
can be run again; until a new table is complete, the old one stays, and for the time
that ``retention`` gives to readers and other runs also after that. Feeds do not depend
on each other and are submitted a few at a time; Spark shares the cluster among their
jobs. Every stage checks the configs before its first job.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from contextlib import contextmanager
from typing import Any, TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from feedworks.operators import quality
from feedworks.operators.canonical import build_gold, dealing_of, keyed_rows
from feedworks.operators.refine import (
    REJECTED_COLUMN,
    clean_columns,
    quarantine_columns,
    refine_entity,
    tag_rows,
)
from feedworks.sources.delimited import feed_path, is_unsplittable, read_lines, read_raw
from feedworks.sources.entities import CANONICAL
from feedworks.sources.spec import FeedSpec, check_configs, feeds_of, load_configs
from feedworks.sources.tables import (
    Retention,
    drop_version,
    read_table,
    table_location,
    write_counted,
    write_version,
)

Configs = Mapping[str, Mapping[str, Any]]
Result = TypeVar("Result")

DEFAULT_PARALLELISM = 8


def _for_each(
    spark: SparkSession, items: Iterable[tuple], work: Callable[..., Result], parallelism: int
) -> list[Result]:
    """``work(*item)`` for every item, results in order; the first to fail stops the rest."""
    target = inheritable_thread_target(spark)(work)
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        futures = [pool.submit(target, *item) for item in items]
        done, _ = wait(futures, return_when=FIRST_EXCEPTION)
        failed = next((f for f in futures if f in done and f.exception() is not None), None)
        if failed is not None:
            pool.shutdown(wait=False, cancel_futures=True)
            raise failed.exception()
        return [future.result() for future in futures]


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the time of a stage, unless the session has set it itself."""
    if spark.conf.get(key) != "0":
        yield
        return
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key)


def ingest_client_entity(
    spark: SparkSession,
    client_id: str,
    entity_name: str,
    entity_cfg: FeedSpec | Mapping[str, Any],
    input_dir: str,
    table_name: str,
    source_path: bool = False,
    retention: Retention = Retention(),
    recut: bool = False,
) -> tuple[DataFrame, str, int]:
    """Land one feed; returns (the table's rows, its name, its row count).

    ``recut`` writes the lines of compressed files that cannot be split (gzip and others) once more, in
    even parts, before they are parsed. One task per file unpacks; parsing and everything
    after it use every core. That pays where a feed is a few large files. Feeds whose header is to be
    validated, or whose rows are to carry their real path, are read as they are.
    """

    def land(lines_at: str | None = None) -> int:
        raw = read_raw(spark, client_id, entity_name, entity_cfg, input_dir, source_path, lines_at)
        return write_counted(raw, table_name, {"rows": F.count(F.lit(1))}, (), None, True, retention)["rows"]

    spec = FeedSpec.of(entity_cfg)
    path = feed_path(input_dir, client_id, spec)
    if not recut or source_path or spec.validate_header or not any(map(is_unsplittable, spark.read.text(path).inputFiles())):
        rows = land()
        return read_table(spark, table_name), table_name, rows
    lines = write_version(read_lines(spark, path, spec.header), f"{table_name}_lines", "text")
    try:
        rows = land(table_location(spark, lines))
    finally:
        drop_version(spark, lines)
    return read_table(spark, table_name), table_name, rows


def run_ingest(
    spark: SparkSession,
    client_configs: Configs,
    input_dir: str,
    bronze_schema: str,
    parallelism: int = DEFAULT_PARALLELISM,
    source_path: bool = False,
    retention: Retention = Retention(),
    recut: bool = False,
) -> list[dict[str, Any]]:
    """Land every feed in ``<bronze>.<client>_<entity>``; one report row per feed."""
    check_configs(client_configs)

    def land(client_id: str, entity: str, cfg: Mapping[str, Any]) -> dict[str, Any]:
        name = f"{bronze_schema}.{client_id}_{entity}"
        _, table, rows = ingest_client_entity(spark, client_id, entity, cfg, input_dir, name, source_path, retention, recut)
        return {"client_id": client_id, "entity": entity, "table": table, "row_count": rows}

    return _for_each(spark, feeds_of(client_configs), land, parallelism)


def run_refine(
    spark: SparkSession,
    client_configs: Configs,
    bronze_schema: str,
    silver_schema: str,
    parallelism: int = DEFAULT_PARALLELISM,
    as_views: bool = True,
    retention: Retention = Retention(),
) -> list[dict[str, Any]]:
    """Refine every feed into ``<silver>.<client>_<entity>`` and ``..._quarantine``.

    Both names are views on a third, ``..._refined``, which shows one table that is partitioned by the
    verdict: raw rows are read and typed once, a reader of either name opens
    only the files of its own partition, and both change in one step. ``as_views=False`` writes two tables
    instead, reading the raw rows twice, for catalogs that have no views.

    While the stage runs, a task may hold a file open per verdict; without that Spark would
    sort all rows by their verdict before it writes them.
    """
    check_configs(client_configs)

    def refine(client_id: str, entity: str, cfg: Mapping[str, Any]) -> dict[str, Any]:
        raw = read_table(spark, f"{bronze_schema}.{client_id}_{entity}")
        name = f"{silver_schema}.{client_id}_{entity}"
        write = _write_once if as_views else _write_twice
        clean, quarantined = write(spark, raw, cfg, name, retention)
        return {
            "client_id": client_id,
            "entity": entity,
            "clean_count": clean,
            "quarantine_count": quarantined,
        }

    with _setting(spark, "spark.sql.maxConcurrentOutputFileWriters", "4"):
        return _for_each(spark, feeds_of(client_configs), refine, parallelism)


def _write_once(
    spark: SparkSession, raw: DataFrame, cfg: Mapping[str, Any], name: str, retention: Retention
) -> tuple[int, int]:
    tagged = tag_rows(raw, cfg)
    verdicts = {"clean": F.count_if(~F.col(REJECTED_COLUMN)), "rejected": F.count_if(REJECTED_COLUMN)}
    views = {
        name: (clean_columns(tagged), f"NOT {REJECTED_COLUMN}"),
        f"{name}_quarantine": (quarantine_columns(tagged), REJECTED_COLUMN),
    }
    counted = write_counted(tagged, f"{name}_refined", verdicts, [REJECTED_COLUMN], views, True, retention)
    return counted["clean"], counted["rejected"]


def _write_twice(
    spark: SparkSession, raw: DataFrame, cfg: Mapping[str, Any], name: str, retention: Retention
) -> tuple[int, int]:
    clean, quarantine = refine_entity(raw, cfg)
    rows = {"rows": F.count(F.lit(1))}
    counted = [
        write_counted(part, table, rows, as_view=False, retention=retention)["rows"]
        for part, table in ((clean, name), (quarantine, f"{name}_quarantine"))
    ]
    return counted[0], counted[1]


def run_curate(
    spark: SparkSession,
    client_configs: Configs,
    silver_schema: str,
    gold_schema: str,
    parallelism: int = DEFAULT_PARALLELISM,
    partition_by: Sequence[str] = (),
    retention: Retention = Retention(),
) -> dict[str, int]:
    """Curate each entity some client has into ``<gold>.<entity>``; {entity: row count}.

    ``partition_by``, say ``["client_id"]``, lets a reader of one client open only its files.

    The keys are read once before the rows, to deal those out in proportion and to find keys with very many.
    """
    check_configs(client_configs)
    clients: dict[str, list[str]] = {}
    for client_id, entity, _ in feeds_of(client_configs):
        clients.setdefault(entity, []).append(client_id)

    def curate(entity: str) -> int:
        frames = {c: read_table(spark, f"{silver_schema}.{c}_{entity}") for c in clients[entity]}
        known = CANONICAL[entity]
        gold = build_gold(known, frames, dealing_of(keyed_rows(known, frames), next(iter(known.keys))))
        name, rows = f"{gold_schema}.{entity}", {"rows": F.count(F.lit(1))}
        counted = write_counted(gold, name, rows, partition_by, None, True, retention)
        return counted["rows"]

    entities = [entity for entity in CANONICAL if entity in clients]
    return dict(zip(entities, _for_each(spark, [(e,) for e in entities], curate, parallelism)))


def main(
    bronze_schema: str,
    silver_schema: str,
    gold_schema: str,
    spark: SparkSession,
    source_path: str,
    configs_dir: str | None = None,
    gold_partition_by: Sequence[str] = (),
    keep_source_path: bool = False,
    retention: Retention = Retention(),
    recut: bool = False,
) -> dict[str, int]:
    """All stages over ``<source>/configs`` and ``<source>/input_files``; curated row counts.

    Configs are read by the driver itself: name their folder where ``source_path``
    is storage that only Spark reaches.
    """
    configs = load_configs(f"{source_path}/configs" if configs_dir is None else configs_dir)
    inputs = f"{source_path}/input_files"
    run_ingest(spark, configs, inputs, bronze_schema, source_path=keep_source_path, retention=retention, recut=recut)
    run_refine(spark, configs, bronze_schema, silver_schema, retention=retention)
    return run_curate(spark, configs, silver_schema, gold_schema, partition_by=gold_partition_by, retention=retention)


def gold_table(spark: SparkSession, gold_schema: str, entity: str) -> DataFrame:
    return read_table(spark, f"{gold_schema}.{entity}")


def silver_tables(
    spark: SparkSession, client_configs: Configs, silver_schema: str, suffix: str = ""
) -> dict[quality.Feed, DataFrame]:
    """{(client id, entity): silver rows}; suffix ``_quarantine`` for the rejected ones."""
    return {(c, e): read_table(spark, f"{silver_schema}.{c}_{e}{suffix}") for c, e, _ in feeds_of(client_configs)}


def quarantine_report(spark: SparkSession, client_configs: Configs, silver_schema: str) -> DataFrame:
    """Rejected rows per client, entity and reason, most frequent first."""
    summary = quality.quarantine_summary(silver_tables(spark, client_configs, silver_schema, "_quarantine"))
    return summary.orderBy(F.desc("count"), "client_id", "entity", quality.REASON_COLUMN)
