"""Typing, checking and splitting raw rows."""

from datetime import date
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from feedworks.functions import values
from feedworks.functions.transforms import TRANSFORMS, register_transform
from feedworks.operators.refine import refine_entity, tag_rows
from tests.helpers import PARCELS, column, parcels, strings


def parsed(spark, builder, texts):
    df = strings(spark, ["i", "s"], [(str(i), t) for i, t in enumerate(texts)])
    found = {r.i: r.v for r in df.select("i", builder(F.col("s")).alias("v")).collect()}
    return [found[str(i)] for i in range(len(texts))]


def test_null_tokens(spark):
    texts = ["", "NULL", "null", "None", "N/A", "n/a", None, "  NULL ", "none", "N/a", "\tNULL", " x "]
    assert parsed(spark, values.text_or_null, texts) == [None] * 8 + ["none", "N/a", "\tNULL", "x"]


def test_ints(spark):
    texts = [" 7 ", "+3", "-4", "12.5", "1,234", "unknown", "", "2147483648", "2147483647", None]
    assert parsed(spark, values.parse_int, texts) == [7, 3, -4, None, None, None, None, None, 2147483647, None]


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts=st.lists(st.text(alphabet="0159+-. \t\n\x00\x0b\x1f\x7f\x85\u00a0\u0663eE_,", max_size=6), min_size=1, max_size=60))
def test_int_pattern_changes_no_result(spark, texts):
    assert parsed(spark, values.parse_int, texts) == parsed(spark, lambda c: c.try_cast("int"), texts)


def test_money(spark):
    good = {
        "100.00": "100.00",
        "$1,234.50": "1234.50",
        "12.345": "12.35",
        "-12.345": "-12.35",
        "1e3": "1000.00",
        "-$5": "-5.00",
        "$-5": "-5.00",
        " 7 ": "7.00",
        "$ 8": "8.00",
        "9999999999.99": "9999999999.99",
    }
    bad = ["(5)", "5 USD", "€5", "$", "SOME", "", "10000000000", None]
    assert parsed(spark, values.parse_money, [*good, *bad]) == [*map(Decimal, good.values()), *[None] * len(bad)]


def test_dates(spark):
    by_day = parsed(spark, lambda c: values.parse_date(c, "yyyy-MM-dd"), ["2024-01-02", " 2024-01-02", "2024-02-30", "x"])
    assert by_day == [date(2024, 1, 2), None, None, None]
    iso = "yyyy-MM-dd'T'HH:mm:ss"
    by_time = parsed(spark, lambda c: values.parse_date(c, iso), ["2024-01-02T23:59:59", "2024-01-02"])
    assert by_time == [date(2024, 1, 2), None]


def test_timestamps(spark):
    iso = "yyyy-MM-dd'T'HH:mm:ss"
    texts = ["2024-01-02T03:04:05", " 2024-01-02T03:04:05", "2024-01-02T03:04:05Z", "2024-01-02 03:04:05", "2024-1-2T03:04:05"]
    found = parsed(spark, lambda c: values.parse_timestamp(c, iso).cast("string"), texts)
    assert found == ["2024-01-02 03:04:05", None, None, None, None]


def test_flags(spark):
    read = parsed(spark, lambda c: values.parse_flag(c, ["Y", "true"], ["N"]), ["Y", " true ", "N", "TRUE", "", None])
    assert read == [True, True, False, None, None, None]
    assert parsed(spark, lambda c: values.parse_flag(c, [], []), ["Y"]) == [None]


@pytest.mark.parametrize(
    ("name", "first", "last"),
    [
        ("Ines Falk", "Ines", "Falk"),
        ("  Olga  van Dyk ", "Olga", "van Dyk"),
        ("Zita", "Zita", None),
        ("Kit|Marlow", "Kit|Marlow", None),
        ("Una\tfold", "Una", "fold"),
        ("", None, None),
        ("   ", None, None),
        (None, None, None),
        ("NULL", "NULL", None),
    ],
)
def test_split_full_name(spark, name, first, last):
    row = TRANSFORMS["split_full_name"](strings(spark, ["full_name"], [(name,)])).first()
    assert (row.first_name, row.last_name) == (first, last)


def test_good_row_has_types(spark):
    clean, quarantine = refine_entity(parcels(spark, {}), PARCELS)
    row = clean.first()
    assert quarantine.count() == 0
    assert (row.fee, row.returned, row.grams, str(row.sent_ts)) == (Decimal("18.40"), False, 450, "2023-03-05 14:30:00")
    types = dict(clean.dtypes)
    assert [types[c] for c in ("fee", "returned", "grams", "sent_ts")] == ["decimal(12,2)", "boolean", "int", "timestamp"]


def test_column_order_with_replacement_in_place(spark):
    clean, quarantine = refine_entity(parcels(spark, {}), PARCELS)
    expected = [
        "parcel", "sender", "fee", "unit", "grams", "sent_on", "returned", "_corrupt_record",
        "_client_id", "client_id", "source_parcel_id", "source_sender_id", "sent_ts", "_silver_refined_ts",
    ]
    assert clean.columns == expected
    assert quarantine.columns == [*expected, "_raw", "_quarantine_reason"]


def test_bad_amount_is_quarantined_with_its_text(spark):
    clean, quarantine = refine_entity(parcels(spark, {"fee": "SOME"}), PARCELS)
    row = quarantine.first()
    assert clean.count() == 0
    assert (row.fee, row._raw.fee, row._quarantine_reason) == (None, "SOME", "missing_required_field:fee")


DATE_TEXTS = st.text(alphabet="0123-/.T: aMrzJun\u0663\u00a0\n\x00Z", max_size=12)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts=st.lists(DATE_TEXTS, min_size=1, max_size=60))
def test_guards_change_no_result(spark, texts):
    texts = [*texts, "2021-12-03", "3 Jun 2021", "Mar", "2021-12-03T01:02:03", "", "  "]
    for pattern in ("yyyy-MM-dd", "yyyy-MM-dd'T'HH:mm:ss", "d MMM yyyy", "MMM", "[HH:mm]"):
        day = parsed(spark, lambda c: values.parse_date(c, pattern), texts)
        assert day == parsed(spark, lambda c: F.try_to_date(c, pattern), texts)
        time = parsed(spark, lambda c: values.parse_timestamp(c, pattern), texts)
        assert time == parsed(spark, lambda c: F.try_to_timestamp(c, F.lit(pattern)), texts)
    for c in "$,":
        texts = [t.replace("/", c) for t in texts]

    def bare(c):
        for sign in ("$", ","):
            c = F.replace(c, F.lit(sign), F.lit(""))
        return c.try_cast("decimal(12,2)")

    assert parsed(spark, values.parse_money, texts) == parsed(spark, lambda c: bare(F.trim(c)), texts)


def test_bad_date_and_null_token_stay_clean(spark):
    clean, quarantine = refine_entity(parcels(spark, {"sent_on": "SOMEDAY", "unit": "None"}), PARCELS)
    row = clean.first()
    assert (row.sent_ts, row.unit, quarantine.count()) == (None, None, 0)


def test_reasons(spark):
    raw = parcels(
        spark,
        {"_corrupt_record": "garbage", "fee": "SOME"},
        {"sender": None},
        {"sender": "NULL", "fee": "", "parcel": " "},
    )
    assert column(refine_entity(raw, PARCELS)[1], "_quarantine_reason") == [
        "unparseable_row",
        "missing_required_field:source_sender_id",
        "missing_required_field:source_parcel_id,source_sender_id,fee",
    ]


def test_nothing_required(spark):
    clean, quarantine = refine_entity(parcels(spark, {"fee": "x"}, {"_corrupt_record": "g"}), {"column_map": {}})
    assert (clean.count(), column(quarantine, "_quarantine_reason")) == (1, ["unparseable_row"])


def test_default_currency_overrides(spark):
    cfg = {"column_map": {"unit": "currency"}, "default_currency": "CHF"}
    clean, _ = refine_entity(parcels(spark, {"unit": "NOK"}), cfg)
    assert column(clean, "currency") == ["CHF"]


def test_later_steps_read_what_earlier_ones_made(spark):
    cfg = {"column_map": {"fee": "unit", "unit": "note"}, "int_fields": {"note": "n"}}
    row = refine_entity(parcels(spark, {"fee": " 5 ", "unit": "x"}), cfg)[0].first()
    assert (row.fee, row.unit, row.note, row.n) == (" 5 ", "5", "5", 5)


SOURCES = st.sampled_from(["a", "b", "c", "C"])
TARGETS = st.sampled_from(["a", "B", "c", "d"])
CELL = st.sampled_from([" 1 ", "NULL", "$2", "2024-01-01", "Y", "x", "7", None])


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    renames=st.dictionaries(SOURCES, TARGETS, max_size=3),
    ints=st.dictionaries(SOURCES, TARGETS, max_size=2),
    flags=st.dictionaries(SOURCES, TARGETS, max_size=2),
    rows=st.lists(st.tuples(CELL, CELL, CELL), min_size=1, max_size=6),
)
def test_one_select_equals_one_column_at_a_time(spark, renames, ints, flags, rows):
    raw = strings(spark, ["a", "b", "c"], rows)
    raw = raw.withColumns({"_corrupt_record": F.lit(None).cast("string"), "_client_id": F.lit("x")})
    stepwise = raw.withColumn("client_id", F.col("_client_id"))
    cfg = {
        "column_map": renames,
        "int_fields": ints,
        "boolean_fields": {r: {"target": t, "true_values": ["Y"], "false_values": ["x"]} for r, t in flags.items()},
    }
    steps = [(r, t, values.text_or_null) for r, t in renames.items()]
    steps += [(r, t, values.parse_int) for r, t in ints.items()]
    steps += [(r, t, lambda c: values.parse_flag(c, ["Y"], ["x"])) for r, t in flags.items()]
    try:
        for source, target, build in steps:
            stepwise = stepwise.withColumn(target, build(F.col(source)))
        expected = stepwise.collect()
    except AnalysisException:  # a step reads a column that is not there
        return
    got = refine_entity(raw, cfg)[0].drop("_silver_refined_ts")
    assert got.columns == stepwise.columns
    assert got.collect() == expected


def test_steps_may_read_typed_columns(spark):
    cfg = {
        "int_fields": {"fee": "n", "n": "m"},
        "decimal_fields": {"n": "d"},
        "boolean_fields": {"m": {"target": "f", "true_values": ["5"], "false_values": []}},
    }
    row = refine_entity(parcels(spark, {"fee": "5"}), cfg)[0].first()
    assert (row.n, row.m, row.d, row.f) == (5, 5, Decimal("5.00"), True)


def test_replacing_ignores_case_but_takes_the_new_name(spark):
    clean, _ = refine_entity(parcels(spark, {"unit": " NULL "}), {"column_map": {"unit": "Unit"}})
    assert "Unit" in clean.columns and "unit" not in clean.columns
    assert column(clean, "Unit") == [None]


def test_unusual_column_names(spark):
    df = strings(spark, ["a.b", "c d", "e`f", "_corrupt_record", "_client_id"], [("1", "2", "3", None, "x")])
    cfg = {"int_fields": {"a.b": "n"}, "column_map": {"c d": "m", "e`f": "o"}, "required_fields": ["n"]}
    row = refine_entity(df, cfg)[0].first()
    assert (row.n, row.m, row.o) == (1, "2", "3")


def test_custom_transform_runs_between_renames_and_types(spark):
    register_transform("cents", lambda df: df.withColumn("fee", F.concat("fee", F.lit("99"))), ("fee",))
    try:
        clean, bad = refine_entity(
            parcels(spark, {"fee": "5."}, {"fee": "x"}), {**PARCELS, "special_transform": "cents"}
        )
        assert column(clean, "fee") == [Decimal("5.99")]
        assert bad.first()._raw.fee == "x"
    finally:
        del TRANSFORMS["cents"]


def test_unknown_transform(spark):
    with pytest.raises(KeyError):
        refine_entity(parcels(spark, {}), {**PARCELS, "special_transform": "nope"})


def test_unknown_required_field_fails_analysis(spark):
    with pytest.raises(AnalysisException, match="UNRESOLVED_COLUMN"):
        refine_entity(parcels(spark, {}), {"required_fields": ["absent"]})


def test_refining_is_lazy_and_needs_no_python_workers(spark):
    plan = tag_rows(parcels(spark, {}), PARCELS)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


TEXTS = st.one_of(
    st.none(),
    st.sampled_from(["", "NULL", "1", "$2,000.5", "SOME", "true", "2024-01-01T00:00:00", " 7 "]),
    st.text(alphabet="aA0159.,$- \t'\"\\N/", max_size=8),
)


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(st.tuples(*[TEXTS] * 8), min_size=1, max_size=12))
def test_every_row_is_clean_or_quarantined(spark, rows):
    """No text raises, no row is lost or doubled, and clean rows have all they need."""
    columns = ["parcel", "sender", "fee", "unit", "grams", "sent_on", "returned", "_corrupt_record"]
    raw = strings(spark, columns, rows).withColumn("_client_id", F.lit("depot_9"))
    tagged = tag_rows(raw, PARCELS).collect()
    assert len(tagged) == len(rows)
    for row, given_cells in zip(tagged, rows):
        complete = None not in (row.source_parcel_id, row.source_sender_id, row.fee)
        assert row._rejected == (given_cells[7] is not None or not complete)
        assert (row._quarantine_reason is not None) == row._rejected == (row._raw is not None)


def test_raw_text_is_kept_where_it_was_replaced(spark):
    raw = refine_entity(parcels(spark, {"fee": "x", "unit": " NULL "}), PARCELS)[1].first()._raw.asDict()
    assert raw == {"fee": "x", "unit": " NULL ", "grams": "450", "returned": "nein"}


def test_feed_with_a_client_id_of_its_own(spark):
    df = strings(spark, ["client_id", "_corrupt_record", "_client_id"], [("theirs", "bad", "ours")])
    row = refine_entity(df, {})[1].first()
    assert (row.client_id, row._raw.asDict()) == ("ours", {"client_id": "theirs"})


def test_no_raw_column_where_nothing_is_replaced(spark):
    cfg = {"column_map": {"parcel": "source_parcel_id"}, "required_fields": ["source_parcel_id"]}
    clean, quarantine = refine_entity(parcels(spark, {"parcel": ""}), cfg)
    assert quarantine.columns == [*clean.columns, "_quarantine_reason"]
    assert quarantine.first().parcel == ""


def test_transform_outputs_count_as_replaced(spark):
    df = strings(spark, ["full_name", "last_name", "_corrupt_record", "_client_id"], [("A B", "raw", "bad", "x")])
    row = refine_entity(df, {"special_transform": "split_full_name"})[1].first()
    assert (row.last_name, row._raw.asDict()) == ("B", {"last_name": "raw"})
