"""Tables, stage drivers and whole runs on small files."""

import gzip
import itertools
import shutil
import threading
import time

import pytest
import yaml
from pyspark import TaskContext
from pyspark.sql import functions as F

from checks.messy_feeds import CONFIGS
from feedworks.plans import sizing, stages
from feedworks.sources import tables
from feedworks.sources.entities import CANONICAL, CanonicalEntity, register_entity
from feedworks.sources.tables import ensure_schema, read_table, write_counted, write_table
from tests.helpers import column, land

A_CUSTOMERS = """customer_id,first_name,last_name,email,phone,signup_ts,status,loyalty_points
1,Ann,Lee,a@x.test,555,2024-01-05T10:00:00,active,10
2,Bob,Ray,NULL,,bad,active,x
,No,Id,n@x.test,,2024-01-05T10:00:00,active,1
BROKEN
"""
A_TRANSACTIONS = """transaction_id,customer_id,amount,currency,channel,created_ts,discount_code,is_refund
T1,1,"$1,234.50",USD,web,2024-02-01T08:00:00,N/A,true
T2,2,SOME,USD,web,2024-02-01T08:00:00,,false
T3,9,5,USD,web,2024-02-01T08:00:00,,0
T3,9,6,USD,web,2024-02-01T08:00:00,,0
"""
C_TRANSACTIONS = "id\tuser_id\tprice_usd\ttax\tfinal_amount\tpayment_type\n1\t4\t1\t2\t3\tcard\n"

names = itertools.count()


@pytest.fixture
def schemas(spark, tmp_path):
    run = next(names)
    return {
        layer: ensure_schema(spark, "spark_catalog", f"run{run}_{layer}", str(tmp_path / "db" / layer))
        for layer in ("bronze", "silver", "gold")
    }


@pytest.fixture
def source(tmp_path):
    configs = tmp_path / "source" / "configs"
    configs.mkdir(parents=True)
    only_transactions = {k: v for k, v in CONFIGS["client_c"].items() if k != "customers"}
    for client_id, cfg in (("client_a", CONFIGS["client_a"]), ("client_c", only_transactions)):
        (configs / f"{client_id}.yaml").write_text(yaml.safe_dump(cfg))
    inputs = tmp_path / "source" / "input_files"
    land(inputs, "client_a", "customers_2024_01.txt", A_CUSTOMERS)
    land(inputs, "client_a", "transactions_2024_01.txt", A_TRANSACTIONS)
    land(inputs, "client_c", "transactions.txt", C_TRANSACTIONS)
    return str(tmp_path / "source")


def loaded(source):
    return stages.load_configs(f"{source}/configs")


def test_schema_creation_is_repeatable(spark):
    assert ensure_schema(spark, "spark_catalog", "twice") == "spark_catalog.twice"
    assert ensure_schema(spark, "spark_catalog", "twice") == "spark_catalog.twice"
    assert spark.catalog.databaseExists("spark_catalog.twice")


def test_overwrite_replaces_rows_and_schema(spark, schemas):
    name = f"{schemas['bronze']}.t"
    write_table(spark.range(5), name)
    write_table(spark.range(2).select(F.col("id").cast("string").alias("other")), name)
    table = read_table(spark, name)
    assert (table.columns, table.count()) == (["other"], 2)


def test_counts_of_a_write(spark, schemas):
    rows = {"rows": F.count(F.lit(1)), "odd": F.count_if(F.col("id") % 2 == 1)}
    assert write_counted(spark.range(7), f"{schemas['bronze']}.n", rows) == {"rows": 7, "odd": 3}
    assert write_counted(spark.range(0), f"{schemas['bronze']}.n", rows) == {"rows": 0, "odd": 0}


def test_counts_are_exact_when_tasks_run_again(spark, schemas):
    def fails_once(batches):
        yield from batches
        if TaskContext.get().attemptNumber() == 0 and TaskContext.get().partitionId() == 1:
            raise RuntimeError("lost")

    df = spark.range(1000, numPartitions=4).mapInPandas(fails_once, "id long")
    name = f"{schemas['bronze']}.retried"
    assert write_counted(df, name, {"rows": F.count(F.lit(1))}) == {"rows": 1000}
    assert read_table(spark, name).count() == 1000


def test_counts_do_not_depend_on_the_listener_bus(spark, schemas, source, monkeypatch):
    """Lost observations are made up for from the written tables, without a thread that still waits."""
    good, threads = tables.write_counted, threading.active_count()
    monkeypatch.setattr(stages, "write_counted", lambda *args, **kw: good(*args, **kw, wait=0.05))
    monkeypatch.setattr(tables, "_arrived", lambda seen: False)
    configs = loaded(source)
    ingest = stages.run_ingest(spark, configs, f"{source}/input_files", schemas["bronze"])
    refine = stages.run_refine(spark, configs, schemas["bronze"], schemas["silver"])
    assert [r["row_count"] for r in ingest] == [4, 4, 1]
    assert [(r["clean_count"], r["quarantine_count"]) for r in refine] == [(2, 2), (3, 1), (1, 0)]
    assert stages.run_curate(spark, configs, schemas["silver"], schemas["gold"]) == {"customers": 2, "transactions": 3}
    assert threading.active_count() <= threads + 1


def test_counts_from_footers_read_no_column(spark, schemas):
    rows = spark.range(1000).withColumn("odd", F.col("id") % 2 == 1)
    write_table(rows, f"{schemas['bronze']}.counted", partition_by=["odd"])
    table = read_table(spark, f"{schemas['bronze']}.counted")
    counts = {"odd": F.count_if("odd"), "all": F.count(F.lit(1))}
    assert tables.footer_metrics(table, counts) == {"odd": 500, "all": 1000}
    plan = table.agg(*counts.values())._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan


def test_whole_run(spark, schemas, source):
    counts = stages.main(schemas["bronze"], schemas["silver"], schemas["gold"], spark, source)
    assert counts == {"customers": 2, "transactions": 3}
    gold = stages.gold_table(spark, schemas["gold"], "transactions")
    amounts = {r.transaction_key: str(r.amount) for r in gold.collect()}
    assert amounts == {"client_a_T1": "1234.50", "client_a_T3": "6.00", "client_c_1": "3.00"}
    assert {r.currency for r in gold.filter("client_id = 'client_c'").collect()} == {"USD"}


def test_running_again_changes_nothing(spark, schemas, source):
    first = stages.main(schemas["bronze"], schemas["silver"], schemas["gold"], spark, source)
    before = {r.transaction_key for r in stages.gold_table(spark, schemas["gold"], "transactions").collect()}
    assert stages.main(schemas["bronze"], schemas["silver"], schemas["gold"], spark, source) == first
    after = {r.transaction_key for r in stages.gold_table(spark, schemas["gold"], "transactions").collect()}
    assert before == after


def test_stage_reports(spark, schemas, source):
    configs = loaded(source)
    ingest = stages.run_ingest(spark, configs, f"{source}/input_files", schemas["bronze"])
    assert [(r["client_id"], r["entity"], r["row_count"]) for r in ingest] == [
        ("client_a", "customers", 4),
        ("client_a", "transactions", 4),
        ("client_c", "transactions", 1),
    ]
    assert ingest[0]["table"] == f"{schemas['bronze']}.client_a_customers"
    refine = stages.run_refine(spark, configs, schemas["bronze"], schemas["silver"])
    assert [(r["clean_count"], r["quarantine_count"]) for r in refine] == [(2, 2), (3, 1), (1, 0)]
    report = stages.quarantine_report(spark, configs, schemas["silver"])
    assert [tuple(r) for r in report.collect()] == [
        ("client_a", "customers", "missing_required_field:source_customer_id", 1),
        ("client_a", "customers", "unparseable_row", 1),
        ("client_a", "transactions", "missing_required_field:amount", 1),
    ]


@pytest.mark.parametrize("as_views", [True, False])
def test_silver_names(spark, schemas, source, as_views):
    configs = loaded(source)
    stages.run_ingest(spark, configs, f"{source}/input_files", schemas["bronze"])
    stages.run_refine(spark, configs, schemas["bronze"], schemas["silver"], as_views=as_views)
    clean = read_table(spark, f"{schemas['silver']}.client_a_transactions")
    quarantine = read_table(spark, f"{schemas['silver']}.client_a_transactions_quarantine")
    assert quarantine.columns == [*clean.columns, "_raw", "_quarantine_reason"]
    assert clean.columns[-1] == "_silver_refined_ts"
    assert sorted(column(clean, "transaction_id")) == ["T1", "T3", "T3"]
    assert [r._raw.amount for r in quarantine.collect()] == ["SOME"]
    # A feed without rejected rows has an empty quarantine, not a missing one.
    assert read_table(spark, f"{schemas['silver']}.client_c_transactions_quarantine").count() == 0


def test_silver_may_change_between_views_and_tables(spark, schemas, source):
    configs = loaded(source)
    stages.run_ingest(spark, configs, f"{source}/input_files", schemas["bronze"])
    reports = [
        stages.run_refine(spark, configs, schemas["bronze"], schemas["silver"], as_views=as_views)
        for as_views in (False, True, True, False, False)
    ]
    assert all(report == reports[0] for report in reports)
    assert read_table(spark, f"{schemas['silver']}.client_a_transactions").count() == 3


def test_clean_view_opens_only_its_own_files(spark, schemas, source):
    configs = loaded(source)
    stages.run_ingest(spark, configs, f"{source}/input_files", schemas["bronze"])
    stages.run_refine(spark, configs, schemas["bronze"], schemas["silver"])
    clean = read_table(spark, f"{schemas['silver']}.client_a_transactions").select("amount")
    assert clean.inputFiles() and all("/_rejected=false/" in f for f in clean.inputFiles())
    plan = clean._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<amount:decimal(12,2)>" in plan


def test_only_entities_some_client_has(spark, schemas, source):
    configs = {"client_c": loaded(source)["client_c"]}
    stages.run_ingest(spark, configs, f"{source}/input_files", schemas["bronze"])
    stages.run_refine(spark, configs, schemas["bronze"], schemas["silver"])
    assert stages.run_curate(spark, configs, schemas["silver"], schemas["gold"]) == {"transactions": 1}
    assert not spark.catalog.tableExists(f"{schemas['gold']}.customers")


def test_config_mistake_stops_before_any_table(spark, schemas, source, tmp_path):
    bad = tmp_path / "source" / "configs" / "client_d.yaml"
    bad.write_text("customers: {file: x}")
    with pytest.raises(ValueError, match="client_d.customers"):
        stages.main(schemas["bronze"], schemas["silver"], schemas["gold"], spark, source)
    assert not [t for t in spark.catalog.listTables(schemas["bronze"]) if not t.isTemporary]


@pytest.mark.parametrize("parallelism", [1, 4])
def test_missing_file_stops_the_run(spark, schemas, source, tmp_path, parallelism):
    shutil.move(tmp_path / "source/input_files/client_a/customers_2024_01.txt", tmp_path / "elsewhere.txt")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        stages.run_ingest(spark, loaded(source), f"{source}/input_files", schemas["bronze"], parallelism)


def test_jobs_per_run(spark, schemas, source):
    """One write per feed and stage plus one per curated table; nothing is read again to be counted."""
    configs = loaded(source)
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    stages.run_ingest(spark, configs, f"{source}/input_files", schemas["bronze"], parallelism=1)
    stages.run_refine(spark, configs, schemas["bronze"], schemas["silver"], parallelism=1)
    assert len(set(tracker.getJobIdsForGroup(None)) - before) == 2 * 3


def test_settings_follow_the_input():
    small = sizing.session_settings(10 * sizing.GIB, cores=8)
    large = sizing.session_settings(100_000 * sizing.GIB, cores=4000)
    assert small["spark.sql.shuffle.partitions"] == "40"
    assert large["spark.sql.shuffle.partitions"] == str(100_000 * 4)
    assert sizing.session_settings(sizing.MIB, cores=8)["spark.sql.shuffle.partitions"] == "8"
    same = "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.coalescePartitions.parallelismFirst"
    assert [small[k] for k in same] == [large[k] for k in same] == [str(256 * sizing.MIB), "false"]
    own = sizing.session_settings(sizing.GIB, 8, partition_bytes=sizing.MIB, scan_bytes=7, parallelism_first=True)
    assert [own[k] for k in ("spark.sql.shuffle.partitions", *same)] == ["1024", "7", "true"]


def failing(df):
    return df.withColumn("boom", F.when(F.lit(True), F.raise_error(F.lit("lost"))).cast("int"))


def versions(spark, schema):
    return [t.name for t in spark.catalog.listTables(schema) if "__v" in t.name]


@pytest.mark.parametrize("as_view", [True, False])
def test_a_failed_write_leaves_the_old_table(spark, schemas, as_view):
    name = f"{schemas['bronze']}.kept"
    write_table(spark.range(5), name, as_view=as_view)
    with pytest.raises(Exception, match="lost"):
        write_table(failing(spark.range(9)), name, as_view=as_view)
    assert (read_table(spark, name).columns, read_table(spark, name).count()) == (["id"], 5)
    write_table(spark.range(2), name, as_view=as_view, retention=tables.AT_ONCE)
    assert read_table(spark, name).count() == 2
    assert len(versions(spark, schemas["bronze"])) == (1 if as_view else 0)


def test_rows_can_be_appended_to_what_a_name_shows(spark, schemas):
    name = f"{schemas['bronze']}.grows"
    write_table(spark.range(5), name)
    write_table(spark.range(2), name, mode="append")
    assert read_table(spark, name).count() == 7


def test_a_failed_stage_leaves_all_layers_readable(spark, schemas, source, monkeypatch):
    counts = stages.main(schemas["bronze"], schemas["silver"], schemas["gold"], spark, source)
    configs = loaded(source)

    def state():
        report = [tuple(r) for r in stages.quarantine_report(spark, configs, schemas["silver"]).collect()]
        gold = {e: stages.gold_table(spark, schemas["gold"], e).count() for e in counts}
        bronze = read_table(spark, f"{schemas['bronze']}.client_a_transactions").count()
        return report, gold, bronze, versions(spark, schemas["silver"]) + versions(spark, schemas["gold"])

    before = state()
    for name, run in (
        ("read_raw", lambda: stages.run_ingest(spark, configs, f"{source}/input_files", schemas["bronze"])),
        ("tag_rows", lambda: stages.run_refine(spark, configs, schemas["bronze"], schemas["silver"])),
        ("build_gold", lambda: stages.run_curate(spark, configs, schemas["silver"], schemas["gold"])),
    ):
        with monkeypatch.context() as patch:
            good = getattr(stages, name)
            patch.setattr(stages, name, lambda *args, good=good: failing(good(*args)))
            with pytest.raises(Exception, match="lost"):
                run()
        assert state() == before
    again = stages.main(
        schemas["bronze"], schemas["silver"], schemas["gold"], spark, source, retention=tables.AT_ONCE
    )
    assert again == counts
    assert len(versions(spark, schemas["silver"])) == 3 and len(versions(spark, schemas["gold"])) == 2


def test_two_writers_and_an_open_reader(spark, schemas):
    """Each finds whole tables, whoever publishes first; the last one that publishes is shown."""
    name = f"{schemas['bronze']}.shared"
    write_table(spark.range(5), name)
    open_reader = read_table(spark, name)
    late = tables.write_version(spark.range(100), name)
    early = tables.write_version(spark.range(20), name)
    tables.publish(spark, name, early)
    reader_between = read_table(spark, name)
    assert (open_reader.count(), reader_between.count()) == (5, 20)
    tables.publish(spark, name, late)
    assert read_table(spark, name).count() == 100
    assert (open_reader.count(), reader_between.count()) == (5, 20)
    assert len(versions(spark, schemas["bronze"])) == 3
    # The next run, with nobody left to wait for, keeps its own version only.
    write_table(spark.range(3), name, retention=tables.AT_ONCE)
    assert len(versions(spark, schemas["bronze"])) == 1 and read_table(spark, name).count() == 3


def test_two_runs_of_a_stage_at_once(spark, schemas, source):
    configs = loaded(source)
    stages.run_ingest(spark, configs, f"{source}/input_files", schemas["bronze"])
    runs = stages._for_each(
        spark, [()] * 4, lambda: stages.run_refine(spark, configs, schemas["bronze"], schemas["silver"]), 4
    )
    assert runs[0] == runs[1] == runs[2] == runs[3]
    for row in runs[0]:
        silver = f"{schemas['silver']}.{row['client_id']}_{row['entity']}"
        assert read_table(spark, silver).count() == row["clean_count"]
        assert read_table(spark, f"{silver}_quarantine").count() == row["quarantine_count"]


def test_versions_go_when_their_time_is_over(spark, schemas, monkeypatch):
    name, hour = f"{schemas['bronze']}.aging", 3600
    left = tables.write_version(spark.range(1), name)  # its run never publishes it
    keep, clock = tables.Retention(superseded=hour, abandoned=24 * hour), tables._now()
    for rows, passed, remaining in ((2, 0, 2), (3, hour / 2, 3), (4, 2 * hour, 3), (5, 2 * hour, 3), (6, 30 * hour, 2)):
        clock += int(passed * 1000)
        monkeypatch.setattr(tables, "_now", lambda: clock)
        write_table(spark.range(rows), name, retention=keep)
        assert read_table(spark, name).count() == rows
        assert len(versions(spark, schemas["bronze"])) == remaining
    assert not spark.catalog.tableExists(left)


def test_what_is_shown_never_goes(spark, schemas):
    name = f"{schemas['bronze']}.shown"
    write_table(spark.range(5), name)
    # As if another run had noted it as old in the moment before it was shown.
    tables._mark(spark, tables.shown_version(spark, name), tables.SUPERSEDED)
    tables._sweep(spark, name, tables.AT_ONCE)
    assert read_table(spark, name).count() == 5


def views_of(columns):
    return {"part.low": (columns, "id < 10"), "part.high": (columns, "id >= 10")}


@pytest.mark.parametrize("columns", [["id"], ["id", "b"], ["id", "a"]])
@pytest.mark.parametrize("fails_at", range(6))
def test_names_of_a_group_change_together(spark, schemas, monkeypatch, columns, fails_at):
    """Wherever publishing stops, all names show one version."""
    base = f"{schemas['bronze']}.whole"
    views = {f"{schemas['bronze']}.{n.split('.')[1]}": part for n, part in views_of(["id", "a"]).items()}
    old = spark.range(20).withColumn("a", F.lit(1)).withColumn("b", F.lit(2))
    tables.publish(spark, base, tables.write_version(old, base), views)
    version = tables.write_version(spark.range(5, 15).withColumn("b", F.lit(2)).withColumn("a", F.lit(1)), base)
    again = {name: (columns, condition) for name, (_, condition) in views.items()}
    steps, good = iter(range(100)), tables._show

    def show(*args):
        if next(steps) == fails_at:
            raise RuntimeError("stopped")
        good(*args)

    with monkeypatch.context() as patch:
        patch.setattr(tables, "_show", show)
        try:
            tables.publish(spark, base, version, again)
            stopped = False
        except RuntimeError:
            stopped = True
    counts = tuple(read_table(spark, name).count() for name in views)
    assert counts in ((10, 10), (5, 5)) if stopped else counts == (5, 5)
    assert spark.table(base).count() == sum(counts)
    tables.publish(spark, base, version, again)
    assert all(read_table(spark, name).columns == columns for name in views)
    assert tuple(read_table(spark, name).count() for name in views) == (5, 5)


def test_an_unchanged_group_is_switched_by_one_statement(spark, schemas, monkeypatch):
    base = f"{schemas['bronze']}.whole"
    views = {f"{schemas['bronze']}.low": (["id"], "id < 10")}
    tables.publish(spark, base, tables.write_version(spark.range(20), base), views)
    seen, good = [], tables._show
    monkeypatch.setattr(tables, "_show", lambda *args: (seen.append(args[1]), good(*args)))
    tables.publish(spark, base, tables.write_version(spark.range(3), base), views)
    assert seen == [base] and read_table(spark, next(iter(views))).count() == 3


def test_a_table_in_the_way_of_a_view_is_kept_until_the_view_is_there(spark, schemas, monkeypatch):
    name = f"{schemas['bronze']}.was_table"
    write_table(spark.range(5), name, as_view=False)
    version = tables.write_version(spark.range(9), name)
    with pytest.raises(Exception, match="nowhere"):
        tables._show(spark, name, "SELECT 1 FROM nowhere")
    assert read_table(spark, name).count() == 5
    tables.publish(spark, name, version)
    assert read_table(spark, name).count() == 9 and len(versions(spark, schemas["bronze"])) == 2


def test_a_new_session_can_run_over_an_old_warehouse(spark, schemas, source, tmp_path):
    """What an in-memory catalog forgets stays in its folder, and is in nobody's way."""
    first = stages.main(schemas["bronze"], schemas["silver"], schemas["gold"], spark, source)
    for layer in ("gold", "silver", "bronze"):
        place = str(tmp_path / "db" / layer)
        shutil.copytree(place, f"{place}-again")
        schemas[layer] = ensure_schema(spark, "spark_catalog", f"again{next(names)}_{layer}", f"{place}-again")
    assert stages.main(schemas["bronze"], schemas["silver"], schemas["gold"], spark, source) == first


def test_every_stage_checks_the_configs(spark, schemas):
    configs = {"x": {"customers": {"file": "f", "delimiter": ",", "columns": ["id"], "require_fields": ["id"]}}}
    for run in (
        lambda: stages.run_ingest(spark, configs, "/nowhere", schemas["bronze"]),
        lambda: stages.run_refine(spark, configs, schemas["bronze"], schemas["silver"]),
        lambda: stages.run_curate(spark, configs, schemas["silver"], schemas["gold"]),
    ):
        with pytest.raises(ValueError, match="unknown key 'require_fields'"):
            run()


def test_refine_does_not_sort_in_a_default_session(spark, schemas, source, monkeypatch):
    key = "spark.sql.maxConcurrentOutputFileWriters"
    assert spark.conf.get(key) == "0"
    configs = loaded(source)
    stages.run_ingest(spark, configs, f"{source}/input_files", schemas["bronze"])
    seen = []
    good = stages.write_counted
    monkeypatch.setattr(stages, "write_counted", lambda *args: (seen.append(spark.conf.get(key)), good(*args))[1])
    stages.run_refine(spark, configs, schemas["bronze"], schemas["silver"])
    assert set(seen) == {"4"} and spark.conf.get(key) == "0"
    tagged = stages.tag_rows(read_table(spark, f"{schemas['bronze']}.client_a_transactions"), configs["client_a"]["transactions"])

    def sorts():
        name = f"{schemas['silver']}.planned{next(names)}"
        spark.sql(f"CREATE TABLE {name} USING parquet PARTITIONED BY (_rejected) AS SELECT * FROM {{t}}", t=tagged.limit(0))
        tagged.createOrReplaceTempView("tagged")
        return "Sort [_rejected" in spark.sql(f"EXPLAIN INSERT INTO {name} SELECT * FROM tagged").first()[0]

    assert sorts()
    spark.conf.set(key, "4")
    try:
        assert not sorts()
    finally:
        spark.conf.unset(key)


def test_curated_tables_by_client(spark, schemas, source):
    stages.main(schemas["bronze"], schemas["silver"], schemas["gold"], spark, source, gold_partition_by=["client_id"])
    gold = stages.gold_table(spark, schemas["gold"], "transactions")
    one = gold.filter("client_id = 'client_c'")
    assert one.count() == 1
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(client_id" in plan


def test_source_path_passes_through(spark, schemas, source):
    stages.main(schemas["bronze"], schemas["silver"], schemas["gold"], spark, source, keep_source_path=True)
    rows = read_table(spark, f"{schemas['silver']}.client_a_transactions").collect()
    assert {r._source_path.rsplit("/", 1)[1] for r in rows} == {"transactions_2024_01.txt"}


def test_a_third_entity(spark, schemas, source, tmp_path):
    register_entity(
        CanonicalEntity("returns", "client_id string, source_return_id string, reason string, _silver_refined_ts timestamp",
                        {"return_key": "source_return_id"})
    )
    try:
        feed = {"file": "r.txt", "delimiter": ";", "columns": ["no", "why"], "required_fields": ["source_return_id"],
                "column_map": {"no": "source_return_id", "why": "reason"}}
        (tmp_path / "source" / "configs" / "client_r.yaml").write_text(yaml.safe_dump({"returns": feed}))
        land(tmp_path / "source" / "input_files", "client_r", "r.txt", "no;why\n1;late\n;lost\n")
        counts = stages.main(schemas["bronze"], schemas["silver"], schemas["gold"], spark, source)
        assert counts == {"customers": 2, "transactions": 3, "returns": 1}
        assert stages.gold_table(spark, schemas["gold"], "returns").first().return_key == "client_r_1"
    finally:
        del CANONICAL["returns"]


def test_the_first_failure_stops_the_rest(spark):
    started, release = [], threading.Event()

    def work(i):
        started.append(i)
        if i == 3:
            raise RuntimeError("third")
        release.wait(20)
        return i

    begin = time.perf_counter()
    timer = threading.Timer(3, release.set)
    timer.start()
    with pytest.raises(RuntimeError, match="third"):
        stages._for_each(spark, [(i,) for i in range(40)], work, 4)
    assert time.perf_counter() - begin < 15 and len(started) < 20


FOLDED = {
    "file": "folded.csv.gz", "delimiter": ";", "columns": ["source_customer_id", "name"],
    "required_fields": ["source_customer_id"],
}


def zipped(tmp_path, *parts, **changes):
    """A feed of gzip files, and its configs."""
    for i, body in enumerate(parts):
        folder = tmp_path / "in" / "folder_1"
        folder.mkdir(parents=True, exist_ok=True)
        with gzip.open(folder / (f"part{i}.gz" if len(parts) > 1 else FOLDED["file"]), "wt", newline="") as file:
            file.write(body)
    return {"folder_1": {"customers": {**FOLDED, **({"file": "*.gz"} if len(parts) > 1 else {}), **changes}}}, str(tmp_path / "in")


def landed(spark, name):
    return sorted(map(str, read_table(spark, name).drop("_ingestion_ts").collect()))


ODD_LINES = (
    "id;name\n1;plain\n\n   \n2;\"quo;ted\"\n3;\"dou\"\"bled\"\n4\n5;a;b\n6;\x01 control \r\n;\n7; spaced \n8;\"open\nid;name\n9;ü€"
)


@pytest.mark.parametrize("header", [True, False])
@pytest.mark.parametrize("parts", [1, 3])
def test_recut_lines_are_parsed_as_they_were(spark, schemas, tmp_path, parts, header):
    configs, inputs = zipped(tmp_path, *[ODD_LINES] * parts, header=header)
    name = f"{schemas['bronze']}.folder_1_customers"
    plain = stages.run_ingest(spark, configs, inputs, schemas["bronze"])
    expected = landed(spark, name)
    assert stages.run_ingest(spark, configs, inputs, schemas["bronze"], recut=True) == plain
    assert landed(spark, name) == expected and len(expected) == parts * (11 if header else 12)
    assert not [t for t in spark.catalog.listTables(schemas["bronze"]) if "_lines" in t.name]


def test_recut_feeds_use_all_cores(spark, schemas, tmp_path):
    """One gzip file of many blocks: parsed, and refined, by as many tasks as there are parts."""
    body = "id;name\n" + "".join(f"{i};{hash(str(i))}{hash(str(-i))}\n" for i in range(60_000))
    configs, inputs = zipped(tmp_path, body)
    name = f"{schemas['bronze']}.folder_1_customers"
    files, tasks = {}, {}
    # Parts in proportion to this little file.
    sizes = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k", "spark.sql.files.maxPartitionBytes": "256k",
             "spark.sql.files.openCostInBytes": "1"}
    for key, value in sizes.items():
        spark.conf.set(key, value)
    try:
        for recut in (False, True):
            assert stages.run_ingest(spark, configs, inputs, schemas["bronze"], recut=recut)[0]["row_count"] == 60_000
            files[recut] = len(read_table(spark, name).inputFiles())
            tasks[recut] = stages.refine_entity(read_table(spark, name), configs["folder_1"]["customers"])[0].rdd.getNumPartitions()
    finally:
        for key in sizes:
            spark.conf.unset(key)
    assert files[False] == 1 and min(files[True], tasks[True]) >= 8


def test_a_failed_recut_leaves_no_lines(spark, schemas, tmp_path, monkeypatch):
    configs, inputs = zipped(tmp_path, ODD_LINES)
    good = stages.read_raw
    monkeypatch.setattr(stages, "read_raw", lambda *args: failing(good(*args)))
    with pytest.raises(Exception, match="lost"):
        stages.run_ingest(spark, configs, inputs, schemas["bronze"], recut=True)
    assert not [t for t in spark.catalog.listTables(schemas["bronze"]) if not t.isTemporary]


def test_feeds_that_are_not_recut(spark, schemas, tmp_path):
    configs, inputs = zipped(tmp_path, "source_customer_id;name\n1;x\n", validate_header=True)
    assert stages.run_ingest(spark, configs, inputs, schemas["bronze"], recut=True)[0]["row_count"] == 1
    stages.run_ingest(spark, configs, inputs, schemas["bronze"], source_path=True, recut=True)
    assert read_table(spark, f"{schemas['bronze']}.folder_1_customers").first()["_source_path"].endswith("folded.csv.gz")


def test_curate_sorts_behind_the_shuffle_only(spark, schemas, source, monkeypatch):
    """A sort before it takes a task's whole split, which spills once splits are larger than a task's memory."""
    configs, plans, good = loaded(source), {}, stages.write_counted
    stages.run_ingest(spark, configs, f"{source}/input_files", schemas["bronze"])
    stages.run_refine(spark, configs, schemas["bronze"], schemas["silver"])

    def write(df, table, *args):
        plans[table] = df._jdf.queryExecution().executedPlan().toString()
        return good(df, table, *args)

    monkeypatch.setattr(stages, "write_counted", write)
    counts = stages.run_curate(spark, configs, schemas["silver"], schemas["gold"])
    assert len(plans) == len(counts) == 2 and min(counts.values()) > 0
    for plan in plans.values():
        assert plan.count("Exchange") == 1
        behind, before = plan.split("Exchange")
        assert "Sort" in behind and "Sort" not in before
