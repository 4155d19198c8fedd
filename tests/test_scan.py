"""The raw scan of delimited text."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from feedworks.sources.delimited import raw_schema, read_raw
from tests.helpers import column, land

FEED = {"file": "buoys.csv", "delimiter": ",", "header": True, "columns": ["buoy", "place", "state"]}
HEADER = "buoy,place,state\n"


def scan(spark, folder, body, **changes):
    feed = {**FEED, **changes}
    return read_raw(spark, "coast", "transactions", feed, land(folder, "coast", feed["file"], body))


def bad_lines(df):
    """Spark refuses to read the corrupt column of raw text alone, so take all columns."""
    return [row._corrupt_record for row in df.collect() if row._corrupt_record is not None]


def test_schema_is_all_strings_with_corrupt_last():
    schema = raw_schema(["a", "b"])
    assert schema.names == ["a", "b", "_corrupt_record"]
    assert {f.dataType.typeName() for f in schema} == {"string"} and all(f.nullable for f in schema)


def test_good_rows_and_lineage(spark, tmp_path):
    df = scan(spark, tmp_path, HEADER + "1,Skagen Rev,lit\n2,Hirtshals,\n")
    assert df.columns == [*FEED["columns"], "_corrupt_record", "_client_id", "_entity", "_source_file", "_ingestion_ts"]
    rows = {r.buoy: r for r in df.collect()}
    assert (rows["1"].place, rows["1"]._corrupt_record) == ("Skagen Rev", None)
    assert rows["2"].state is None
    assert (rows["1"]._client_id, rows["1"]._entity, rows["1"]._source_file) == ("coast", "transactions", "buoys.csv")
    assert len({r._ingestion_ts for r in rows.values()}) == 1


def test_ragged_lines_are_kept_whole(spark, tmp_path):
    df = scan(spark, tmp_path, HEADER + "1,a,b\nLOOSE\n2,a,b,extra\n")
    assert set(bad_lines(df)) == {"LOOSE", "2,a,b,extra"}
    assert set(column(df, "buoy")) == {"1", "LOOSE", "2"}


def test_corrupt_lines_are_noticed_by_narrow_queries(spark, tmp_path):
    df = scan(spark, tmp_path, HEADER + "1,a,b\nLOOSE\n2,a,b,extra\n")
    assert len(df.select("buoy", "_corrupt_record").filter("_corrupt_record IS NOT NULL").collect()) == 2
    assert df.agg(F.count("_corrupt_record"), F.count("buoy")).first()[:] == (2, 3)


@pytest.mark.parametrize("sep", [",", "|", "\t"])
def test_quoted_delimiter(spark, tmp_path, sep):
    body = sep.join(FEED["columns"]) + "\n" + sep.join(["1", f'"north{sep}west"', "lit"]) + "\n"
    row = scan(spark, tmp_path, body, delimiter=sep).first()
    assert (row.place, row._corrupt_record) == (f"north{sep}west", None)


def test_doubled_quote(spark, tmp_path):
    assert scan(spark, tmp_path, HEADER + '1,"q""q",x\n').first().place == 'q"q'


def test_other_quote_character(spark, tmp_path):
    assert scan(spark, tmp_path, HEADER + "1,'a,b',x\n", quote="'").first().place == "a,b"


def test_dangling_quotes(spark, tmp_path):
    df = scan(spark, tmp_path, HEADER + '1,"open,x\n2,x,"dang\n3,x,"\n')
    rows = {r.buoy: r for r in df.collect()}
    assert rows["1"]._corrupt_record == '1,"open,x'
    assert (rows["2"].state, rows["2"]._corrupt_record) == ("dang", None)
    assert (rows["3"].state, rows["3"]._corrupt_record) == ('"', None)


def test_line_break_inside_quotes_gives_two_bad_rows(spark, tmp_path):
    df = scan(spark, tmp_path, HEADER + '1,"two\nlines",x\n')
    assert len(bad_lines(df)) == 2


def test_blank_lines_are_no_rows(spark, tmp_path):
    df = scan(spark, tmp_path, HEADER + "1,a,b\n\n   \n,,\n")
    assert sorted(column(df, "buoy"), key=str) == ["1", None]
    assert bad_lines(df) == []


def test_line_of_tabs_is_blank_in_a_tab_feed(spark, tmp_path):
    assert scan(spark, tmp_path, "buoy\tplace\tstate\n1\ta\tb\n\t\t\n", delimiter="\t").count() == 1


def test_empty_file(spark, tmp_path):
    assert scan(spark, tmp_path, "").count() == 0


def test_without_header(spark, tmp_path):
    assert set(column(scan(spark, tmp_path, "1,a,b\n2,a,b\n", header=False), "buoy")) == {"1", "2"}


def test_header_names_do_not_matter_and_repeats_are_data(spark, tmp_path):
    assert column(scan(spark, tmp_path, "x,y,z\nbuoy,place,state\n"), "buoy") == ["buoy"]


def test_header_can_be_checked(spark, tmp_path):
    good = scan(spark, tmp_path / "good", HEADER + "1,a,b\nBAD\n", validate_header=True)
    assert bad_lines(good) == ["BAD"]
    moved = scan(spark, tmp_path / "moved", "place,buoy,state\n1,a,b\n", validate_header=True)
    with pytest.raises(Exception, match="(?i)header"):
        moved.collect()


def test_folder_of_files_each_with_header(spark, tmp_path):
    land(tmp_path, "coast/buoys.csv", "part1", HEADER + "1,a,b\n")
    land(tmp_path, "coast/buoys.csv", "part2", HEADER + "2,a,b\n")
    df = read_raw(spark, "coast", "transactions", FEED, str(tmp_path))
    assert set(column(df, "buoy")) == {"1", "2"}


def test_the_file_that_a_row_came_from(spark, tmp_path):
    land(tmp_path, "coast/buoys.csv", "part1", HEADER + "1,a,b\nLOOSE\n")
    land(tmp_path, "coast/buoys.csv", "part2", HEADER + "2,a,b\n")
    df = read_raw(spark, "coast", "transactions", FEED, str(tmp_path), source_path=True)
    assert {r.buoy: r._source_path.rsplit("/", 1)[1] for r in df.collect()} == {"1": "part1", "LOOSE": "part1", "2": "part2"}
    assert df.columns[-1] == "_source_path" and {r._source_file for r in df.collect()} == {"buoys.csv"}


def test_large_file_is_split(spark, tmp_path):
    body = HEADER + "".join(f"{i},place,lit\n" for i in range(20000))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        df = scan(spark, tmp_path, body)
        assert df.select(F.spark_partition_id()).distinct().count() > 3
        assert df.agg(F.count("buoy"), F.count("_corrupt_record")).first()[:] == (20000, 0)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(lines=st.lists(st.text(alphabet='ab1 ,"\t|\'\\#$', max_size=12), max_size=15))
def test_every_line_that_is_not_blank_is_one_row(spark, tmp_path_factory, lines):
    """And if it did not parse, its text is kept whole."""
    df = scan(spark, tmp_path_factory.mktemp("lines"), HEADER + "\n".join(lines) + "\n")
    kept = [line for line in lines if line.strip()]
    assert len(df.collect()) == len(kept)
    assert set(bad_lines(df)) <= set(kept)


def test_missing_file_stops(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_raw(spark, "coast", "transactions", FEED, str(tmp_path)).collect()
