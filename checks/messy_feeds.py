"""Messy feeds derived from the ``customer`` and ``orders`` tables.

Every supplier delivers all customers and all orders in its own layout, so the same
ids mean different rows for different suppliers. Lines are damaged by fixed rules on
the row key, so the right outcome of every row can be stated without parsing text.
Text is written by Spark as many part files, each with its own header line.
"""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import threading
import uuid
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedworks.operators.refine import refine_entity
from feedworks.plans import stages
from feedworks.sources.delimited import read_raw
from feedworks.sources.spec import feeds_of, load_configs
from feedworks.sources.tables import ensure_schema, quoted

CONFIGS_DIR = str(Path(__file__).resolve().parents[1] / "examples" / "configs")
CONFIGS = load_configs(CONFIGS_DIR)
CLIENTS = list(CONFIGS)
FEEDS = [(client_id, entity) for client_id, entity, _ in feeds_of(CONFIGS)]

ISO = "yyyy-MM-dd'T'HH:mm:ss"
TRANSACTION_DEFECTS = 97
CUSTOMER_DEFECTS = 53


def spec(client_id: str, entity: str) -> dict:
    return CONFIGS[client_id][entity]


def text(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))


def in_quotes(value: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))


def choose(subject: Column, cases: dict, otherwise: Column) -> Column:
    """``CASE subject WHEN .. THEN .. ELSE otherwise``."""
    return functools.reduce(lambda rest, case: F.when(subject == case[0], case[1]).otherwise(rest), cases.items(), otherwise)


def money(value: Column) -> Column:
    return text(value.cast("decimal(12,2)"))


def _customer_cells(client_id: str, k: Column, m: Column) -> list[Column]:
    key = choose(m, {1: F.lit("")}, text(k))
    day = text(F.date_add(F.lit("2024-01-01").cast("date"), (k % 28).cast("int")))
    if client_id == "client_a":
        return [
            key,
            F.lit("Customer"),
            in_quotes(F.substr(F.col("c_name"), F.lit(10))),
            choose(m, {8: F.lit("null")}, F.concat(F.lit("u"), text(k), F.lit("@x.test"))),
            F.lit(""),
            F.concat(choose(m, {7: F.lit("2024-02-30")}, day), F.lit("T00:00:00")),
            in_quotes(text(F.col("c_mktsegment"))),
            choose(m, {10: F.lit("12.5")}, text(F.col("c_nationkey"))),
        ]
    day = choose(m, {7: F.lit("2024-02-30")}, day)
    if client_id == "client_b":
        names = {
            3: F.lit("Zita"),
            4: F.lit('"Kit|Marlow"'),
            5: F.lit(""),
            6: F.lit("  Olga  van Dyk "),
        }
        street = choose(m, {11: F.concat(text(k), F.lit(' "Old" | Street'))}, F.concat(text(k), F.lit(" Main | Street")))
        return [
            key,
            choose(m, names, F.concat(F.lit("First"), text(k), F.lit(" Last"), text(k))),
            choose(m, {8: F.lit("None")}, F.concat(F.lit("u"), text(k), F.lit("@x.test"))),
            F.concat(F.lit("C"), text(F.col("c_nationkey"))),
            in_quotes(street),
            text(k % 1000),
            day,
            choose(m, {9: F.lit("maybe")}, F.when(k % 2 == 0, "Y").otherwise("N")),
        ]
    return [
        key,
        F.concat(F.lit("F"), text(k)),
        F.concat(F.lit("L"), text(k)),
        day,
        F.when(k % 10 == 0, "unknown").otherwise(text(20 + k % 50)),
        choose(m, {9: F.lit("maybe")}, F.when(k % 2 == 0, "1").otherwise("0")),
    ]


def _transaction_cells(client_id: str, k: Column, m: Column, amount: Column) -> list[Column]:
    """Cells of one transaction line whose good amount is ``amount``."""
    customer = text(F.col("o_custkey"))
    key = choose(m, {14: F.concat(F.lit(" "), text(k), F.lit("  "))}, text(k))
    customer = choose(
        m, {4: F.lit(""), 8: F.lit("NULL"), 14: F.concat(F.lit("  "), customer, F.lit(" "))}, customer
    )
    amount_cell = choose(m, {1: F.lit("SOME"), 5: F.lit('"$1,234.50"'), 8: F.lit("")}, money(amount))
    when = choose(m, {7: F.lit("SOMEDAY")}, text(F.date_format("o_orderdate", ISO)))
    priority = text(F.col("o_orderpriority"))
    if client_id == "client_a":
        refund = choose(F.col("o_orderstatus"), {"F": F.lit("true"), "O": F.lit("0")}, F.lit(""))
        currency = choose(m, {6: F.lit("N/A")}, F.lit("USD"))
        return [key, customer, amount_cell, currency, in_quotes(priority), when, F.lit("N/A"), refund]
    if client_id == "client_b":
        currency = choose(m, {6: F.lit("N/A")}, F.lit("EUR"))
        return [key, customer, amount_cell, currency, when, text(k % 7), priority]
    tax = text(((k % 1000).cast("decimal(12,2)") / 100).cast("decimal(12,2)"))
    return [key, customer, money(F.col("o_totalprice")), tax, amount_cell, priority]


def feed_lines(spark: SparkSession, sf_dir: str, client_id: str, entity: str) -> DataFrame:
    """(k, line): the text lines of a feed with the key of the row each stems from."""
    sep = spec(client_id, entity)["delimiter"]

    def line(cells: list[Column]) -> Column:
        return F.concat_ws(sep, *cells)

    if entity == "customers":
        rows = spark.read.parquet(f"{sf_dir}/customer.parquet")
        k = F.col("c_custkey")
        m = k % CUSTOMER_DEFECTS
        lines = choose(m, {2: text(k)}, line(_customer_cells(client_id, k, m)))
        return rows.select(k.alias("k"), lines.alias("line"))

    rows = spark.read.parquet(f"{sf_dir}/orders.parquet")
    k = F.col("o_orderkey")
    m = k % TRANSACTION_DEFECTS
    price = F.col("o_totalprice").cast("decimal(12,2)")
    cells = _transaction_cells(client_id, k, m, price)
    redelivered = _transaction_cells(client_id, k, m, price + 1)
    open_quote = F.lit('"')
    shapes = {
        2: F.array(cells[0]),
        3: F.array(line([*cells, F.lit("extra")])),
        9: F.array(line(cells), line(redelivered)),
        10: F.array(line([cells[0], F.concat(open_quote, cells[1]), *cells[2:]])),
        11: F.array(line([*cells[:-1], F.concat(open_quote, cells[-1])])),
        12: F.array(line([F.lit("")] * len(cells))),
        13: F.array(line(cells), F.lit(" ")),
    }
    lines = choose(m, shapes, F.array(line(cells)))
    return rows.select(k.alias("k"), F.explode(lines).alias("line"))


def write_feed(lines: DataFrame, columns: list[str], delimiter: str, path: str) -> None:
    """Write ``line`` as text files that each start with the feed's header line.

    The CSV writer puts the column name at the top of every file. With the whole
    line as its only column and quoting off, that name is the header line.
    """
    header = delimiter.join(columns)
    lines.select(F.col("line").alias(header)).write.csv(
        path,
        mode="overwrite",
        header=True,
        sep="\u0001",
        quote="",
        emptyValue="",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder every executor reaches: inside the cluster's checkpoint folder.

    Only where the session names none, and runs on one machine, is it a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="feedworks-")
    return f"{base.rstrip('/')}/feedworks-{uuid.uuid4().hex}"


_opening = threading.Lock()


def _one_at_a_time(method):
    @functools.wraps(method)
    def locked(self, *args):
        with self._lock:
            return method(self, *args)

    return locked


class Landing:
    """The feeds of one data folder, written once per session and as late as possible.

    ``close`` removes everything again; what a session leaves open is closed when the
    process ends, as far as the session is still there then.
    """

    _open: dict[tuple[str, str], Landing] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._own_base = spark.conf.get("spark.checkpoint.dir", None) is None
        self.root = shared_dir(spark)
        self.input_dir = f"{self.root}/input_files"
        self._written: set[tuple[str, str]] = set()
        self._schemas: dict[str, str] = {}
        self._done: dict[str, object] = {}
        self._lock = threading.RLock()

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> Landing:
        key = (spark.sparkContext.applicationId, sf_dir)
        with _opening:
            if key not in cls._open:
                cls._open[key] = cls(spark, sf_dir)
            return cls._open[key]

    def close(self) -> None:
        """Drop the databases and delete the folder. Frames read from them end here."""
        self._open.pop((self.spark.sparkContext.applicationId, self.sf_dir), None)
        for layer in list(self._schemas):
            self.spark.sql(f"DROP SCHEMA IF EXISTS {quoted(self._schemas.pop(layer))} CASCADE")
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
        if self._own_base:
            shutil.rmtree(self.root.rsplit("/", 1)[0], ignore_errors=True)

    @classmethod
    def close_all(cls) -> None:
        for landing in list(cls._open.values()):
            if landing.spark.sparkContext._jsc is not None:
                landing.close()

    @_one_at_a_time
    def write(self, *feeds: tuple[str, str]) -> None:
        """Write those of the feeds that are not there yet, side by side."""
        missing = [feed for feed in feeds if feed not in self._written]
        with ThreadPoolExecutor(max_workers=len(FEEDS)) as pool:
            list(pool.map(lambda feed: self._write(*feed), missing))
        self._written.update(missing)

    def _write(self, client_id: str, entity: str) -> None:
        feed = spec(client_id, entity)
        lines = feed_lines(self.spark, self.sf_dir, client_id, entity)
        write_feed(lines, feed["columns"], feed["delimiter"], f"{self.input_dir}/{client_id}/{feed['file']}")

    def raw(self, client_id: str, entity: str) -> DataFrame:
        self.write((client_id, entity))
        return read_raw(self.spark, client_id, entity, spec(client_id, entity), self.input_dir)

    def clean(self, client_id: str, entity: str) -> DataFrame:
        return refine_entity(self.raw(client_id, entity), spec(client_id, entity))[0]

    def quarantine(self, client_id: str, entity: str) -> DataFrame:
        return refine_entity(self.raw(client_id, entity), spec(client_id, entity))[1]

    @_one_at_a_time
    def schema(self, layer: str) -> str:
        """A database of this landing's own, kept in its shared folder."""
        if layer not in self._schemas:
            name = f"{self.root.rsplit('/', 1)[1].replace('-', '_')}_{layer}"
            self._schemas[layer] = ensure_schema(self.spark, "spark_catalog", name, f"{self.root}/{layer}")
        return self._schemas[layer]

    @_one_at_a_time
    def ingest_report(self) -> list[dict]:
        if "bronze" not in self._done:
            self.write(*FEEDS)
            self._done["bronze"] = stages.run_ingest(self.spark, CONFIGS, self.input_dir, self.schema("bronze"))
        return self._done["bronze"]

    @_one_at_a_time
    def refine_report(self) -> list[dict]:
        if "silver" not in self._done:
            self.ingest_report()
            self._done["silver"] = stages.run_refine(self.spark, CONFIGS, self.schema("bronze"), self.schema("silver"))
        return self._done["silver"]

    @_one_at_a_time
    def main_report(self) -> dict[str, int]:
        """What a whole run over the written feeds reports, into databases of its own."""
        if "main" not in self._done:
            self.write(*FEEDS)
            layers = [self.schema(f"main_{layer}") for layer in ("bronze", "silver", "gold")]
            self._done["main"] = stages.main(*layers, self.spark, self.root, configs_dir=CONFIGS_DIR)
        return self._done["main"]

    @_one_at_a_time
    def refine_as_tables(self) -> str:
        """The database with the silver tables that ``as_views=False`` writes."""
        if "tables" not in self._done:
            self.ingest_report()
            schema = self.schema("silver_tables")
            stages.run_refine(self.spark, CONFIGS, self.schema("bronze"), schema, as_views=False)
            self._done["tables"] = schema
        return self._done["tables"]

    @_one_at_a_time
    def curate_report(self) -> dict[str, int]:
        if "gold" not in self._done:
            self.refine_report()
            self._done["gold"] = stages.run_curate(self.spark, CONFIGS, self.schema("silver"), self.schema("gold"))
        return self._done["gold"]

    def table(self, layer: str, name: str) -> DataFrame:
        {"bronze": self.ingest_report, "silver": self.refine_report, "gold": self.curate_report}[layer]()
        return self.spark.table(f"{self.schema(layer)}.{name}")


atexit.register(Landing.close_all)
