"""Namespaces and name-addressed tables.

Replacing a table never takes the old one away before the new one is complete. The rows are
written under a name of their own (``<name>__v<...>``); then the public name, a view, is
pointed at it. Several public names that show parts of one table are views on one pointer, a
view as well, so they change together. The version that was shown before stays for as
long as ``Retention`` says: who planned a query on it can finish, and so can a second
run that is still writing its own version. A write that fails leaves the old rows readable, and a
version that it left half done is dropped.
Formats that replace tables in one step are left to do so.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession

#: Formats whose tables Spark replaces by dropping the old files first.
PLAIN_FORMATS = ("parquet", "orc", "json", "csv", "avro", "text")
VERSION = "__v"
#: What versions carry as table properties.
PUBLISHED, SUPERSEDED = "feedworks.published_at", "feedworks.superseded_at"
#: A start that lies this many milliseconds ahead is no time: older releases named versions at random.
NO_TIME = 365 * 24 * 3600 * 1000

#: Which columns and rows a view shows: (columns, condition), None for all.
Views = Mapping[str, tuple[Sequence[str], str] | None]


@dataclass(frozen=True)
class Retention:
    """How long versions stay that no public name shows, in seconds.

    ``superseded`` counts from when another version was shown instead: no query that still
    reads the old one should take longer. ``abandoned`` counts from the start of a write whose version
    was never shown: no run that is still at work should take longer. Versions are looked through, and
    dropped, whenever a version of the same table is published. Times are the drivers' clocks.
    """

    superseded: float = 3600.0
    abandoned: float = 7 * 24 * 3600.0


#: For catalogs with one run at a time and no readers meanwhile: old versions go at once.
AT_ONCE = Retention(0.0, 0.0)


def quoted(name: str) -> str:
    """``a.b`` as an SQL identifier with every part quoted."""
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def ensure_schema(spark: SparkSession, catalog: str, schema: str, location: str | None = None) -> str:
    """Create ``catalog.schema`` if it is not there and return that name.

    ``location`` puts its tables in a given folder; without it the catalog decides.
    """
    name = f"{catalog}.{schema}"
    place = "" if location is None else " LOCATION '{}'".format(location.replace("'", "\\'"))
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quoted(name)}{place}")
    return name


def write_table(
    df: DataFrame,
    table_name: str,
    mode: str = "overwrite",
    table_format: str = "parquet",
    partition_by: Sequence[str] = (),
    as_view: bool = True,
    retention: Retention = Retention(),
) -> None:
    """Save under a name; ``overwrite`` replaces the old rows and the old schema.

    ``as_view=False`` makes the public name a table, for catalogs without views: the old
    table is renamed to a version and the complete new one to the public name. That needs a catalog that still
    knows the old table, leaves the name missing for the moment between the two, and
    moves the files that a reader of the old table has open.
    """
    spark = df.sparkSession
    if table_format.lower() not in PLAIN_FORMATS or mode.lower() != "overwrite":
        target = shown_version(spark, table_name) or table_name
        df.write.format(table_format).mode(mode).partitionBy(*partition_by).saveAsTable(target)
        return
    version = write_version(df, table_name, table_format, partition_by)
    if as_view:
        publish(spark, table_name, version, retention=retention)
        return
    with _set_aside(spark, table_name):
        _rename(spark, version, table_name)
    _sweep(spark, table_name, retention)


def write_version(
    df: DataFrame, table_name: str, table_format: str = "parquet", partition_by: Sequence[str] = ()
) -> str:
    """Write the rows under a new name beside ``table_name`` and return that name."""
    version = _new_version(table_name)
    try:
        df.write.format(table_format).partitionBy(*partition_by).saveAsTable(version)
    except BaseException:
        _drop(df.sparkSession, version)
        raise
    return version


def drop_version(spark: SparkSession, version: str) -> None:
    """Drop a version that was written for steps in between and never published."""
    _drop(spark, version)


def table_location(spark: SparkSession, name: str) -> str:
    """The folder that holds a table's files."""
    told = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(name)}").collect()
    return next(row["data_type"] for row in told if row["col_name"] == "Location")


def _now() -> int:
    return int(time.time() * 1000)


def _new_version(table_name: str) -> str:
    """A name that tells, in its first twelve digits, when it was made."""
    return f"{table_name}{VERSION}{_now():012x}{uuid.uuid4().hex[:20]}"


def _started(version: str) -> int:
    return int(version.rpartition(VERSION)[2][:12], 16)


def publish(
    spark: SparkSession,
    table_name: str,
    version: str,
    views: Views | None = None,
    retention: Retention = Retention(),
) -> None:
    """Show a complete version under public names, then drop versions that ``retention`` has no more use for.

    ``table_name`` itself shows the whole version; replacing it is the one step by which
    all names change. ``views`` are parts of it under names of their own, defined on ``table_name``. They
    are made again only where their definition is another one. For that they first show
    the columns that old and new definition share, which both versions can answer, and get the new ones once
    the switch is done: whatever fails between two steps, all names show the same version.
    """
    parts = {name: part or (None, "true") for name, part in (views or {}).items()}
    texts = {name: _select(table_name, *part) for name, part in parts.items()}
    before = {name: _view_text(spark, name) for name in texts}
    changed = [name for name, text in texts.items() if before[name] != text]
    for name in changed:
        if before[name] is not None and f" FROM {quoted(table_name)} " in before[name]:
            wanted = parts[name][0] or spark.table(version).columns
            shared = [c for c in spark.table(name).columns if c in set(wanted)]
            _show(spark, name, _select(table_name, shared, parts[name][1]))
    _show(spark, table_name, _select(version))
    for name in changed:
        _show(spark, name, texts[name])
    _mark(spark, version, PUBLISHED)
    _sweep(spark, table_name, retention)


def _select(source: str, columns: Sequence[str] | None = None, condition: str = "true") -> str:
    names = "*" if columns is None else ", ".join(quoted_column(c) for c in columns)
    return f"SELECT {names} FROM {quoted(source)} WHERE {condition}"


def _show(spark: SparkSession, view: str, select: str) -> None:
    """A view in one step; a table that has its name becomes a version of it.

    What a view shows is altered: replacing it would drop and create it, with no view in between.
    """
    if is_view(spark, view):
        spark.sql(f"ALTER VIEW {quoted(view)} AS {select}")
        return
    with _set_aside(spark, view):
        spark.sql(f"CREATE VIEW IF NOT EXISTS {quoted(view)} AS {select}")
    if _view_text(spark, view) != select:  # another run was first
        spark.sql(f"ALTER VIEW {quoted(view)} AS {select}")


def _view_text(spark: SparkSession, name: str) -> str | None:
    if not is_view(spark, name):
        return None
    told = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(name)}").collect()
    return next((row["data_type"] for row in told if row["col_name"] == "View Text"), None)


class _set_aside:
    """For the time of a ``with``, what has a name is a version of it; it is put back if that fails."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, name

    def __enter__(self) -> None:
        self.aside, self.text = None, _view_text(self.spark, self.name)
        if self.text is not None:
            _drop(self.spark, self.name)
        elif is_table(self.spark, self.name):
            self.aside = _new_version(self.name)
            _rename(self.spark, self.name, self.aside)

    def __exit__(self, kind, error, trace) -> None:
        if kind is not None and self.text is not None:
            self.spark.sql(f"CREATE VIEW {quoted(self.name)} AS {self.text}")
        elif kind is not None and self.aside is not None:
            _rename(self.spark, self.aside, self.name)
        elif self.aside is not None:
            _mark(self.spark, self.aside, SUPERSEDED)


def _rename(spark: SparkSession, old: str, new: str) -> None:
    # The session's own catalog takes no catalog name here.
    spark.sql(f"ALTER TABLE {quoted(old)} RENAME TO {quoted(new.removeprefix('spark_catalog.'))}")


def _sweep(spark: SparkSession, table_name: str, retention: Retention) -> None:
    """Note which versions are no longer shown, and drop those whose time is over."""
    for version in _versions(spark, table_name):
        # Asked again for each: another run may have published meanwhile. What is shown never goes.
        if _same(version, shown_version(spark, table_name)):
            continue
        since = _property(spark, version, SUPERSEDED)
        random = _started(version) > _now() + NO_TIME
        if since is None and (random or _property(spark, version, PUBLISHED) is not None):
            since = _mark(spark, version, SUPERSEDED)
        start, limit = (_started(version), retention.abandoned) if since is None else (int(since), retention.superseded)
        if _now() - start >= 1000 * limit:
            _drop(spark, version)


def _same(a: str, b: str | None) -> bool:
    return b is not None and a.rpartition(".")[2].lower() == b.rpartition(".")[2].lower()


def _mark(spark: SparkSession, version: str, name: str) -> str:
    now = str(_now())
    spark.sql(f"ALTER TABLE {quoted(version)} SET TBLPROPERTIES ('{name}' = '{now}')")
    return now


def _property(spark: SparkSession, name: str, key: str) -> str | None:
    if not spark.catalog.tableExists(name):
        return None
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {quoted(name)}").collect()}.get(key)


def _versions(spark: SparkSession, table_name: str) -> list[str]:
    schema, _, short = table_name.rpartition(".")
    place = f" IN {quoted(schema)}" if schema else ""
    like = f"{short}{VERSION}*".replace("'", "\\'")
    # SHOW TABLES runs no job, other than the catalog's own listing.
    listed = [row["tableName"] for row in spark.sql(f"SHOW TABLES{place} LIKE '{like}'").collect()]
    mine = re.compile(re.escape(f"{short}{VERSION}".lower()) + "[0-9a-f]{32}")
    return [f"{schema}.{name}" if schema else name for name in listed if mine.fullmatch(name.lower())]


def shown_version(spark: SparkSession, name: str) -> str | None:
    """The version that a public view shows, if it is one."""
    schema, _, short = name.rpartition(".")
    found = re.search(rf" FROM .*?`({re.escape(short)}{VERSION}[0-9a-f]{{32}})` ", _view_text(spark, name) or "", re.I)
    return None if found is None else f"{schema}.{found[1]}" if schema else found[1]


def _drop(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP {'VIEW' if is_view(spark, name) else 'TABLE'} IF EXISTS {quoted(name)}")


def read_table(spark: SparkSession, table_name: str) -> DataFrame:
    return spark.table(table_name)


def write_counted(
    df: DataFrame,
    table: str,
    metrics: Mapping[str, Column],
    partition_by: Sequence[str] = (),
    views: Views | None = None,
    as_view: bool = True,
    retention: Retention = Retention(),
    wait: float = 2.0,
) -> dict[str, int]:
    """Save as a table and take ``metrics`` (aggregates) in the same pass.

    The observed node is the last one before the write, so it runs in the writing
    stage. Spark adds up metrics of that stage once per output partition, which
    keeps them exact when a lost executor makes tasks run again. Observed values travel on
    Spark's listener bus, which drops events when a very large job floods it; if they have not
    arrived ``wait`` seconds after the write, the metrics come from the footers of the written files. So they may
    only use columns that cost a table no read: its partition columns, or none.
    """
    spark, seen = df.sparkSession, Observation()
    named = [metric.alias(name) for name, metric in metrics.items()]
    observed = df.observe(seen, *named)
    if as_view:
        shown = write_version(observed, table, partition_by=partition_by)
    else:
        write_table(observed, table, partition_by=partition_by, as_view=False, retention=retention)
        shown = table
    found = _observed(seen, wait)
    if not found.keys() >= metrics.keys():
        found = footer_metrics(read_table(spark, shown), metrics)
    if as_view:
        publish(spark, table, shown, views, retention)
    return {name: found[name] for name in metrics}


def footer_metrics(written: DataFrame, metrics: Mapping[str, Column]) -> dict[str, int]:
    """``metrics`` of a written table that need none of its stored columns.

    Without a column to read, a Parquet scan takes row counts from the footers and partition
    values from the paths: a few KB of each file, read by as many tasks as there are cores.
    """
    return written.agg(*[metric.alias(name) for name, metric in metrics.items()]).first().asDict()


def _observed(seen: Observation, wait: float) -> dict[str, int]:
    """What was observed, or nothing if it does not arrive in time; asking for it then would wait for ever."""
    until = time.monotonic() + wait
    while not _arrived(seen):
        if time.monotonic() >= until:
            return {}
        time.sleep(0.01)
    return dict(seen.get)


def _arrived(seen: Observation) -> bool:
    return seen._jo.future().isCompleted()


def create_view(
    spark: SparkSession, view: str, table: str, columns: Sequence[str] | None = None, condition: str = "true"
) -> None:
    """Some columns and rows of ``table`` under another name, in place of what had it.

    A table that had the name is kept, as a version of it, until the next sweep.
    """
    _show(spark, view, _select(table, columns, condition))


def is_table(spark: SparkSession, name: str) -> bool:
    return _kind(spark, name) in ("MANAGED", "EXTERNAL")


def is_view(spark: SparkSession, name: str) -> bool:
    return _kind(spark, name) == "VIEW"


def _kind(spark: SparkSession, name: str) -> str | None:
    return spark.catalog.getTable(name).tableType if spark.catalog.tableExists(name) else None


def quoted_column(name: str) -> str:
    return "`{}`".format(name.replace("`", "``"))
