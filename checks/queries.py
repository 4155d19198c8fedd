"""Registered queries: each takes (session, data folder) and returns a DataFrame.

Times are shown as text, so that their value does not depend on how a client
renders a timestamp; load and refine times, which differ per run, are left out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.messy_feeds import CLIENTS, CONFIGS, FEEDS, Landing, choose, money, spec, text
from feedworks.functions import values
from feedworks.functions.frames import union_all
from feedworks.functions.transforms import TRANSFORMS
from feedworks.operators import canonical, quality
from feedworks.operators.refine import refine_entity, tag_rows
from feedworks.plans import stages
from feedworks.sources.delimited import read_raw
from feedworks.sources.entities import CANONICAL, TRANSACTIONS
from feedworks.sources.spec import CORRUPT_COLUMN
from feedworks.sources.tables import (
    AT_ONCE,
    footer_metrics,
    publish,
    read_table,
    shown_version,
    write_table,
    write_version,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RUN_TIMES = ("_ingestion_ts", "_silver_refined_ts")
SECONDS = "yyyy-MM-dd HH:mm:ss"


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def union(frames: list[DataFrame]) -> DataFrame:
    return union_all(frames)


def repeatable(df: DataFrame) -> DataFrame:
    """Without run times, with other timestamps as text."""
    kept = [(f.name, f.dataType.typeName()) for f in df.schema if f.name not in RUN_TIMES]
    return df.select(
        *[F.date_format(name, SECONDS).alias(name) if kind == "timestamp" else F.col(name) for name, kind in kept]
    )


# --- raw scan ---------------------------------------------------------------


def well_formed(df: DataFrame) -> DataFrame:
    return repeatable(df.filter(F.col(CORRUPT_COLUMN).isNull())).drop(CORRUPT_COLUMN)


@query
def bronze_scan_comma(spark: SparkSession, sf_dir: str) -> DataFrame:
    return well_formed(Landing.of(spark, sf_dir).raw("client_a", "transactions"))


@query
def bronze_scan_pipe_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows, also those that did not parse: what was read of them, and their text."""
    return repeatable(Landing.of(spark, sf_dir).raw("client_b", "transactions"))


@query
def bronze_scan_tab_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeatable(Landing.of(spark, sf_dir).raw("client_c", "transactions"))


@query
def bronze_scan_headerless(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that start with data: every line is a row."""
    landing = Landing.of(spark, sf_dir)
    place = f"{landing.input_dir}/headless/lines.txt"
    orders = table(spark, sf_dir, "orders")
    line = F.concat_ws(";", "o_orderkey", F.col("o_totalprice").cast("decimal(12,2)"), "o_orderstatus")
    orders.select(line).write.mode("overwrite").text(place)
    feed = {"file": "lines.txt", "delimiter": ";", "header": False, "columns": ["number", "price", "status"]}
    return well_formed(read_raw(spark, "headless", "orders", feed, landing.input_dir))


@query
def bronze_scan_pipe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return well_formed(Landing.of(spark, sf_dir).raw("client_b", "customers"))


@query
def bronze_scan_tab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return well_formed(Landing.of(spark, sf_dir).raw("client_c", "customers"))


@query
def bronze_corrupt_capture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every transaction line with its first field and, if it did not parse, its text."""
    landing = Landing.of(spark, sf_dir)
    parts = []
    for client_id in CLIENTS:
        first = spec(client_id, "transactions")["columns"][0]
        parts.append(
            landing.raw(client_id, "transactions").select(
                F.col("_client_id").alias("client_id"),
                F.trim(first).alias("id"),
                F.col(CORRUPT_COLUMN).isNotNull().alias("is_corrupt"),
                F.col(CORRUPT_COLUMN).alias("corrupt_text"),
            )
        )
    return union(parts)


@query
def bronze_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the landed tables."""
    landing = Landing.of(spark, sf_dir)
    rows = [landing.table("bronze", f"{c}_{e}").select("_client_id", "_entity") for c, e in FEEDS]
    counts = union(rows).groupBy(F.col("_client_id").alias("client_id"), F.col("_entity").alias("entity"))
    return counts.agg(F.count(F.lit(1)).alias("row_count"))


@query
def table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table saved twice under one name, the second time with another schema.

    A third time fails half way and must leave the second.
    """
    name = f"{Landing.of(spark, sf_dir).schema('scratch')}.orders_copy"
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_totalprice").cast("decimal(12,2)").alias("amount")
    )
    write_table(orders.select("o_orderkey"), name)
    write_table(orders, name)
    fails = F.when(F.col("o_orderkey") % 2 == 0, F.raise_error(F.lit("half way"))).otherwise(F.col("o_orderkey"))
    try:
        write_table(orders.select(fails.cast("bigint").alias("o_orderkey")), name)
    except Exception as err:
        if "half way" not in str(err):
            raise
    return read_table(spark, name).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum("o_orderkey").alias("key_sum"),
        F.sum("amount").cast("decimal(38,2)").alias("amount_sum"),
    )


@query
def versions_and_readers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs that write one table at the same time, and readers that keep what they opened.

    The run that began first is done last. Then a third run drops what nobody reads any more.
    """
    name = f"{Landing.of(spark, sf_dir).schema('scratch')}.shared_orders"
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    write_table(orders, name, retention=AT_ONCE)
    opened = {"before both": read_table(spark, name)}
    slow, quick = (write_version(orders.where(F.col("o_orderstatus") == s), name) for s in ("F", "O"))
    publish(spark, name, quick)
    opened["after the quick one"] = read_table(spark, name)
    publish(spark, name, slow)
    opened["after the slow one"] = read_table(spark, name)
    totals = (F.count(F.lit(1)).alias("row_count"), F.sum("o_orderkey").alias("key_sum"))
    return union([df.agg(*totals).select(F.lit(reader).alias("reader"), "*") for reader, df in opened.items()])


@query
def names_change_together(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two names of one table, after a run that could define only one of them anew: both show what they did before."""
    name = f"{Landing.of(spark, sf_dir).schema('scratch')}.lines"
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_returnflag")
    views = {f"{name}_{flag}": (["l_orderkey", "l_quantity"], f"l_returnflag = '{flag}'") for flag in ("R", "A")}
    publish(spark, name, write_version(lines, name), views)
    later = lines.where("l_orderkey % 2 = 0")
    broken = {f"{name}_R": views[f"{name}_R"], f"{name}_A": (["l_orderkey", "l_quantity"], "no_such_column = 1")}
    version = write_version(later, name)
    try:
        publish(spark, name, version, broken)
    except Exception as err:
        if "no_such_column" not in str(err):
            raise
    shown = F.lit(shown_version(spark, name) is not None)
    parts = [read_table(spark, view).select(F.lit(view[-1]).alias("flag"), "l_orderkey", "l_quantity") for view in views]
    sums = (F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("key_sum"), F.sum("l_quantity").alias("quantity"))
    return union(parts).groupBy("flag").agg(*sums).withColumn("shown", shown)


@query
def footer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean and quarantined rows per feed as the footers of the refined tables tell them, without a column read."""
    landing = Landing.of(spark, sf_dir)
    landing.refine_report()
    verdicts = {"clean_n": F.count_if(F.col("_rejected") == F.lit(False)), "quarantine_n": F.count_if("_rejected")}
    rows = []
    for client_id, entity in FEEDS:
        whole = read_table(spark, f"{landing.schema('silver')}.{client_id}_{entity}_refined")
        told = footer_metrics(whole, verdicts)
        rows.append((client_id, entity, told["clean_n"], told["quarantine_n"]))
    return spark.createDataFrame(rows, "client_id string, entity string, clean_n long, quarantine_n long")


@query
def bronze_recut_gzip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of gzip files, dealt out anew before they are parsed."""
    landing = Landing.of(spark, sf_dir)
    orders = table(spark, sf_dir, "orders")
    line = F.concat_ws(";", "o_orderkey", F.col("o_totalprice").cast("decimal(12,2)"), "o_orderstatus")
    odd = F.when(F.col("o_orderkey") % 10 == 3, F.concat(line, F.lit(";extra"))).otherwise(line)
    place = f"{landing.input_dir}/zipped/lines"
    orders.select(odd).write.mode("overwrite").option("compression", "gzip").text(place)
    feed = {"file": "lines", "delimiter": ";", "header": False, "columns": ["number", "price", "status"]}
    name = f"{landing.schema('scratch')}.zipped_orders"
    rows, _, _ = stages.ingest_client_entity(spark, "zipped", "orders", feed, landing.input_dir, name, recut=True)
    return repeatable(rows).select("number", "price", "status", F.col(CORRUPT_COLUMN).alias("corrupt_text"))


# --- scalar steps -----------------------------------------------------------


def raw_frame(rows: DataFrame, **cells: Column) -> DataFrame:
    """``rows`` as if just landed: the given string cells and the system columns."""
    return rows.select(
        *[value.cast("string").alias(name) for name, value in cells.items()],
        F.lit(None).cast("string").alias(CORRUPT_COLUMN),
        F.lit("client_x").alias("_client_id"),
    )


def refined(rows: DataFrame, cfg: dict, *columns: str) -> DataFrame:
    return refine_entity(rows, cfg)[0].select(*columns)


@query
def rename_null_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve spellings of a currency cell, in turn by order key."""
    spellings = ["", "NULL", "null", "None", "N/A", "n/a", "none", "N/a", "  NULL ", "\tNULL", "USD", " EUR  "]
    orders = table(spark, sf_dir, "orders")
    cell = choose(F.col("o_orderkey") % 12, {i: F.lit(s) for i, s in enumerate(spellings)}, F.lit("?"))
    cfg = {"column_map": {"id": "source_transaction_id", "cur": "currency"}}
    return refined(
        raw_frame(orders, id=F.col("o_orderkey"), cur=cell), cfg, "client_id", "source_transaction_id", "currency"
    )


@query
def split_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    plain = F.concat(F.lit("First"), k, F.lit(" Last"), k)
    shapes = {
        1: F.lit("Zita"),
        2: F.lit(""),
        3: F.lit("   "),
        4: F.lit(None).cast("string"),
        5: F.concat(F.lit("  Olga  van Dyk"), k, F.lit(" ")),
        6: F.concat(F.lit("Una\tfold "), k),
        7: F.lit("NULL"),
        8: F.lit("Kit|Marlow"),
    }
    customers = table(spark, sf_dir, "customer")
    names = customers.select(k.cast("string").alias("id"), choose(k % 10, shapes, plain).alias("full_name"))
    return TRANSFORMS["split_full_name"](names).select("id", "first_name", "last_name")


def event_time(pattern: str) -> Column:
    return F.date_format("ts", pattern)


@query
def parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event days written in several ways, read with a day and with a time pattern."""
    events = table(spark, sf_dir, "events")
    iso = "yyyy-MM-dd'T'HH:mm:ss"
    cell = choose(
        F.col("event_id") % 6,
        {
            1: event_time(iso),
            2: F.lit("2024-02-30"),
            3: F.lit("SOMEDAY"),
            4: F.concat(F.lit(" "), event_time("yyyy-MM-dd")),
            5: F.lit(""),
        },
        event_time("yyyy-MM-dd"),
    )
    cfg = {
        "date_fields": {
            "day": {"target": "by_day", "format": "yyyy-MM-dd", "type": "date"},
            "day_time": {"target": "by_time", "format": iso, "type": "date"},
        }
    }
    rows = raw_frame(events, event_id=F.col("event_id"), day=cell, day_time=cell)
    return refined(rows, cfg, F.col("event_id").cast("bigint"), "by_day", "by_time")


@query
def parse_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    iso = "yyyy-MM-dd'T'HH:mm:ss"
    cell = choose(
        F.col("event_id") % 8,
        {
            1: F.concat(F.lit(" "), event_time(iso)),
            2: F.concat(event_time(iso), F.lit("Z")),
            3: event_time("yyyy-MM-dd HH:mm:ss"),
            4: F.lit("2024-02-30T00:00:00"),
            5: event_time("yyyy-M-d'T'HH:mm:ss"),
            6: event_time("yyyy-MM-dd"),
        },
        event_time(iso),
    )
    cfg = {"date_fields": {"at": {"target": "event_ts", "format": iso, "type": "timestamp"}}}
    rows = refined(
        raw_frame(events, event_id=F.col("event_id"), at=cell), cfg, F.col("event_id").cast("bigint"), "event_ts"
    )
    return repeatable(rows)


@query
def cast_int_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line quantities written in several ways, some of them not an int."""
    number = text(F.col("l_quantity").cast("int"))
    cell = choose(
        (F.col("l_orderkey") + F.col("l_linenumber")) % 10,
        {
            1: F.concat(F.lit(" "), number, F.lit(" ")),
            2: F.concat(F.lit("+"), number),
            3: F.concat(number, F.lit(".5")),
            4: F.lit("1,234"),
            5: F.lit("unknown"),
            6: F.lit(""),
            7: F.lit("2147483648"),
            8: F.concat(F.lit("-"), number),
        },
        number,
    )
    rows = raw_frame(
        table(spark, sf_dir, "lineitem"), order=F.col("l_orderkey"), line=F.col("l_linenumber"), items=cell
    )
    ids = [F.col("order").cast("bigint").alias("l_orderkey"), F.col("line").cast("int").alias("l_linenumber")]
    return refined(rows, {"int_fields": {"items": "quantity"}}, *ids, "quantity")


@query
def cast_decimal_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line prices with currency signs, thousands commas and other notations."""
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    number = text(price)
    cell = choose(
        (F.col("l_orderkey") + F.col("l_linenumber")) % 14,
        {
            1: F.concat(F.lit("$"), F.format_number(price, 2)),
            2: F.concat(F.lit("-$"), number),
            3: F.concat(F.lit("$-"), number),
            4: F.concat(F.lit("  "), number, F.lit(" ")),
            5: F.lit("12.345"),
            6: F.lit("1e3"),
            7: F.concat(F.lit("("), number, F.lit(")")),
            8: F.concat(number, F.lit(" USD")),
            9: F.concat(F.lit("€"), number),
            10: F.lit("$"),
            11: F.lit("SOME"),
            12: F.concat(F.lit("12345678901"), F.lit(".00")),
        },
        number,
    )
    rows = raw_frame(
        table(spark, sf_dir, "lineitem"), order=F.col("l_orderkey"), line=F.col("l_linenumber"), total=cell
    )
    ids = [F.col("order").cast("bigint").alias("l_orderkey"), F.col("line").cast("int").alias("l_linenumber")]
    return refined(rows, {"decimal_fields": {"total": "amount"}}, *ids, "amount")


@query
def map_boolean(spark: SparkSession, sf_dir: str) -> DataFrame:
    spellings = ["true", "1", "false", "0", "", "TRUE", " true ", "yes", "maybe"]
    orders = table(spark, sf_dir, "orders")
    cell = choose(F.col("o_orderkey") % 9, {i: F.lit(s) for i, s in enumerate(spellings)}, F.lit("?"))
    flag = {"target": "flag", "true_values": ["true", "1"], "false_values": ["false", "0"]}
    rows = raw_frame(orders, id=F.col("o_orderkey"), refund=cell)
    return refined(rows, {"boolean_fields": {"refund": flag}}, F.col("id").cast("bigint").alias("o_orderkey"), "flag")


@query
def default_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean transactions per client and currency; client_c has a constant one."""
    landing = Landing.of(spark, sf_dir)
    rows = union([landing.table("silver", f"{c}_transactions").select("client_id", "currency") for c in CLIENTS])
    return rows.groupBy("client_id", "currency").agg(F.count(F.lit(1)).alias("n"))


@query
def default_currency_overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The constant replaces a currency that is already there."""
    orders = table(spark, sf_dir, "orders")
    cell = F.when(F.col("o_orderkey") % 2 == 0, "EUR").otherwise("")
    cfg = {"column_map": {"id": "id", "currency": "currency"}, "default_currency": "USD"}
    return refined(raw_frame(orders, id=F.col("o_orderkey"), currency=cell), cfg, "id", "currency")


# --- clean and quarantined rows ---------------------------------------------


@query
def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every quarantined row of every feed, by the id it was delivered with."""
    landing = Landing.of(spark, sf_dir)
    parts = []
    for client_id, entity in FEEDS:
        first = spec(client_id, entity)["columns"][0]
        rows = landing.table("silver", f"{client_id}_{entity}_quarantine")
        parts.append(
            rows.select(
                "client_id",
                F.lit(entity).alias("entity"),
                F.trim(first).alias("id"),
                F.col("_quarantine_reason").alias("reason"),
            )
        )
    return union(parts)


def raw_text(df: DataFrame) -> DataFrame:
    """``_raw`` as one column per text that it holds."""
    if "_raw" not in df.columns:
        return df
    kept = df.schema["_raw"].dataType.names
    return df.select("*", *[F.col(f"_raw.`{c}`").alias(f"raw_{c}") for c in kept]).drop("_raw")


@query
def quarantine_raw_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected transactions: the typed amount and, where it took its place, the text it came from."""
    landing = Landing.of(spark, sf_dir)
    parts = []
    for client_id in CLIENTS:
        rows = raw_text(landing.quarantine(client_id, "transactions"))
        raw = F.col("raw_amount") if "raw_amount" in rows.columns else F.lit(None).cast("string")
        parts.append(rows.select("client_id", "source_transaction_id", "amount", raw.alias("raw_amount")))
    return union(parts)


def _quarantine(client_id: str, entity: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return raw_text(repeatable(Landing.of(spark, sf_dir).quarantine(client_id, entity)))

    run.__name__ = f"quarantine_{client_id}_{entity}"
    return run


for _feed in FEEDS:
    query(_quarantine(*_feed))


def _silver(client_id: str, entity: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return repeatable(Landing.of(spark, sf_dir).clean(client_id, entity)).drop(CORRUPT_COLUMN)

    run.__name__ = f"silver_{client_id}_{entity}"
    return run


for _feed in FEEDS:
    query(_silver(*_feed))


@query
def chained_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps that read what an earlier step made of a column."""
    orders = table(spark, sf_dir, "orders")
    cell = F.when(F.col("o_orderkey") % 3 == 0, " N/A ").otherwise(F.concat(F.lit(" "), money(F.col("o_totalprice"))))
    cfg = {
        "column_map": {"id": "id", "total": "Total", "Total": "total_text"},
        "decimal_fields": {"total_text": "amount"},
        "int_fields": {"id": "id"},
        "required_fields": ["amount"],
    }
    rows = tag_rows(raw_frame(orders, id=F.col("o_orderkey"), total=cell), cfg)
    return rows.select("id", "Total", "total_text", "amount", F.col("_quarantine_reason").alias("reason"))


@query
def split_conservation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed, clean and quarantined rows per feed, from the written tables."""
    landing = Landing.of(spark, sf_dir)
    landing.refine_report()
    return quality.row_balance(
        stages.silver_tables(spark, CONFIGS, landing.schema("bronze")),
        stages.silver_tables(spark, CONFIGS, landing.schema("silver")),
        stages.silver_tables(spark, CONFIGS, landing.schema("silver"), "_quarantine"),
    )


@query
def silver_as_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean and quarantined rows per feed where refine writes two tables instead of views."""
    schema = Landing.of(spark, sf_dir).refine_as_tables()
    parts = []
    for suffix in ("", "_quarantine"):
        for (client_id, entity), rows in stages.silver_tables(spark, CONFIGS, schema, suffix).items():
            named = F.lit(client_id).alias("client_id"), F.lit(entity).alias("entity")
            parts.append(rows.select(*named, F.lit(suffix == "").alias("is_clean")))
    return union(parts).groupBy("client_id", "entity", "is_clean").agg(F.count(F.lit(1)).alias("n"))


@query
def refine_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per feed: one refine time for all rows, and none before its row was landed."""
    landing = Landing.of(spark, sf_dir)
    parts = []
    for client_id, entity in FEEDS:
        for name in (f"{client_id}_{entity}", f"{client_id}_{entity}_quarantine"):
            rows = landing.table("silver", name)
            named = F.lit(client_id).alias("client_id"), F.lit(entity).alias("entity")
            parts.append(rows.select(*named, "_silver_refined_ts", "_ingestion_ts"))
    return union(parts).groupBy("client_id", "entity").agg(
        (F.count_distinct("_silver_refined_ts") == 1).alias("one_time"),
        F.every(F.col("_silver_refined_ts").isNotNull()).alias("all_set"),
        F.every(F.col("_silver_refined_ts") >= F.col("_ingestion_ts")).alias("after_landing"),
    )


@query
def whole_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The curated row counts that a whole run reports, and those of its tables."""
    landing = Landing.of(spark, sf_dir)
    counts = landing.main_report()
    gold = landing.schema("main_gold")
    tables = [stages.gold_table(spark, gold, e).select(F.lit(e).alias("entity")) for e in counts]
    found = union(tables).groupBy("entity").agg(F.count(F.lit(1)).alias("n"))
    told = F.create_map(*[F.lit(x) for item in counts.items() for x in item])
    return found.withColumn("reported", told[F.col("entity")].cast("bigint"))


@query
def stage_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row counts the stages reported, which they took while writing."""
    landing = Landing.of(spark, sf_dir)
    gold = landing.curate_report()
    rows = [("bronze", r["client_id"], r["entity"], r["row_count"]) for r in landing.ingest_report()]
    for r in landing.refine_report():
        rows.append(("clean", r["client_id"], r["entity"], r["clean_count"]))
        rows.append(("quarantine", r["client_id"], r["entity"], r["quarantine_count"]))
    rows += [("gold", None, entity, n) for entity, n in gold.items()]
    return spark.createDataFrame(rows, "stage string, client_id string, entity string, n bigint")


# --- curated tables ---------------------------------------------------------


def clean_frames(spark: SparkSession, sf_dir: str, entity: str) -> dict[str, DataFrame]:
    landing = Landing.of(spark, sf_dir)
    landing.write(*[(client_id, entity) for client_id in CLIENTS])
    return {client_id: landing.clean(client_id, entity) for client_id in CLIENTS}


@query
def conform_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts seen as canonical transactions: few columns known, the rest typed nulls."""
    parts = table(spark, sf_dir, "part").select(
        F.lit("client_x").alias("client_id"),
        F.col("p_partkey").alias("source_transaction_id"),
        F.col("p_size").cast("bigint").alias("quantity"),
        F.col("p_retailprice").alias("amount"),
        F.col("p_name").alias("not_canonical"),
    )
    return repeatable(canonical.conform(parts, TRANSACTIONS.schema))


@query
def known_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of each canonical column per feed, once its clean rows are conformed."""
    landing = Landing.of(spark, sf_dir)
    parts = []
    for client_id, entity in FEEDS:
        known = CANONICAL[entity]
        rows = canonical.conform(landing.clean(client_id, entity), known.schema)
        names = [c for c in known.columns if c not in RUN_TIMES]
        counts = rows.agg(*[F.count(c).alias(c) for c in names])
        cells = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("n")) for c in names])).alias("c")
        parts.append(counts.select(F.lit(client_id).alias("client_id"), F.lit(entity).alias("entity"), cells))
    return union(parts).select("client_id", "entity", F.col("c.name").alias("column"), F.col("c.n").alias("n"))


@query
def union_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per client and entity over the union, before duplicates are removed."""
    landing = Landing.of(spark, sf_dir)
    parts = []
    for entity in CANONICAL.values():
        frames = [landing.table("silver", f"{c}_{entity.name}") for c in CLIENTS]
        rows = canonical.union_clients(frames, entity.schema)
        parts.append(rows.select("client_id", F.lit(entity.name).alias("entity")))
    return union(parts).groupBy("client_id", "entity").agg(F.count(F.lit(1)).alias("n"))


@query
def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.concat(F.lit("client_"), F.col("o_custkey") % 3).alias("client_id"),
        F.when(F.col("o_orderkey") % 5 != 0, F.col("o_custkey").cast("string")).alias("source_customer_id"),
    )
    return orders.select("o_orderkey", values.surrogate_key("client_id", "source_customer_id").alias("customer_key"))


@query
def dedupe_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last event of each user."""
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type")
    latest = canonical.keep_latest(events, "user_id", order="ts", tie_break=["event_id"])
    return latest.select("user_id", "event_id", "event_type", F.date_format("ts", SECONDS).alias("ts"))


@query
def dedupe_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line per order where many share the time: the other columns decide."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.to_date("l_shipdate").alias("ship_day"),
        F.col("l_quantity").cast("int").alias("quantity"),
        "l_linenumber",
        "l_returnflag",
    )
    lines = lines.withColumn("ship_day", F.when(F.col("l_orderkey") % 2 == 0, F.col("ship_day")))
    return canonical.keep_latest(lines, "l_orderkey", order="ship_day")


@query
def dedupe_by_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line per order, as the largest struct: the last day, then the smallest tie left to the other columns."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_linenumber",
        "l_orderkey",
        F.when(F.col("l_orderkey") % 3 > 0, F.to_date("l_shipdate")).alias("ship_day"),
        F.col("l_linestatus").alias("mode"),
    )
    return canonical.keep_latest(lines, "l_orderkey", order="ship_day", tie_break=["mode"], how="aggregate")


@query
def gold_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeatable(canonical.build_gold_customers(clean_frames(spark, sf_dir, "customers")))


@query
def gold_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeatable(canonical.build_gold_transactions(clean_frames(spark, sf_dir, "transactions")))


def curated(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    landing = Landing.of(spark, sf_dir)
    landing.curate_report()
    return stages.gold_table(spark, landing.schema("gold"), entity)


@query
def gold_customers_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The curated customers as the stages wrote them."""
    return repeatable(curated(spark, sf_dir, "customers"))


@query
def gold_transactions_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The curated transactions as the stages wrote them."""
    return repeatable(curated(spark, sf_dir, "transactions"))


@query
def gold_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = Landing.of(spark, sf_dir)
    rows = [landing.table("gold", e).select(F.lit(e).alias("entity")) for e in CANONICAL]
    return union(rows).groupBy("entity").agg(F.count(F.lit(1)).alias("n"))


# --- reports ----------------------------------------------------------------


@query
def quarantine_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = Landing.of(spark, sf_dir)
    landing.refine_report()
    report = stages.quarantine_report(spark, CONFIGS, landing.schema("silver"))
    return report.select("client_id", "entity", F.col("_quarantine_reason").alias("reason"), F.col("count").alias("n"))


@query
def quarantine_reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The per-feed form of the summary, for every feed."""
    landing = Landing.of(spark, sf_dir)
    parts = []
    for client_id, entity in FEEDS:
        rows = quality.reason_counts(landing.quarantine(client_id, entity))
        named = F.lit(client_id).alias("client_id"), F.lit(entity).alias("entity")
        parts.append(rows.select(*named, F.col("_quarantine_reason").alias("reason"), F.col("count").alias("n")))
    return union(parts)


@query
def quarantine_top_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five most frequent lines of the summary."""
    landing = Landing.of(spark, sf_dir)
    landing.refine_report()
    silver = stages.silver_tables(spark, CONFIGS, landing.schema("silver"), "_quarantine")
    summary = quality.quarantine_summary(silver)
    top = quality.top_reasons(summary, 5)
    return top.select("client_id", "entity", F.col("_quarantine_reason").alias("reason"), F.col("count").alias("n"))


@query
def transactions_with_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = Landing.of(spark, sf_dir)
    joined = quality.enrich_transactions(
        landing.table("gold", "transactions"),
        landing.table("gold", "customers"),
        ["first_name", "email", "signup_date"],
    )
    return joined.select("transaction_key", "customer_key", "amount", "first_name", "email", "signup_date")


@query
def customers_with_free_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customers where prefixed names are taken as well."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_key"),
        F.col("o_orderkey").alias("number"),
        F.col("o_orderstatus").alias("segment"),
        F.col("o_orderpriority").alias("CUSTOMER_SEGMENT"),
    )
    people = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    return quality.enrich_transactions(orders, people)


@query
def orphan_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = Landing.of(spark, sf_dir)
    return quality.orphan_transactions(landing.table("gold", "transactions"), landing.table("gold", "customers"))


