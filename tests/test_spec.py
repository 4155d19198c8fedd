"""Loading and checking feed specs."""

import copy

import pytest
from pyspark.sql import functions as F

from checks.messy_feeds import CONFIGS, CONFIGS_DIR
from feedworks.functions import transforms
from feedworks.sources.spec import FeedSpec, check_configs, feed_problems, list_client_ids, load_client_config

FEED = {"file": "f.txt", "delimiter": ",", "columns": ["id", "name", "flag"], "column_map": {"id": "source_customer_id"}}


@pytest.mark.parametrize("content", ["", "\n\n", "# nothing yet\n# delimiter: ';'\n", "---\n", "~"])
def test_config_without_content_names_its_path(tmp_path, content):
    (tmp_path / "harbour.yaml").write_text(content)
    with pytest.raises(ValueError, match="harbour.yaml"):
        load_client_config(str(tmp_path), "harbour")


def test_config_is_read_as_it_stands(tmp_path):
    (tmp_path / "harbour.yaml").write_text("transactions: {delimiter: ';', columns: [nr, fee]}\n# end\n")
    assert load_client_config(str(tmp_path), "harbour") == {"transactions": {"delimiter": ";", "columns": ["nr", "fee"]}}


def test_ids_are_sorted_yaml_names(tmp_path):
    for name in ("b.yaml", "a.yaml", "notes.txt", "c.yml"):
        (tmp_path / name).write_text("x: 1")
    assert list_client_ids(str(tmp_path)) == ["a", "b"]


def test_example_configs_are_valid():
    assert list_client_ids(CONFIGS_DIR) == ["client_a", "client_b", "client_c"]
    assert check_configs(CONFIGS) == {c: ["customers", "transactions"] for c in CONFIGS}


def test_defaults():
    spec = FeedSpec.of(FEED)
    assert (spec.header, spec.quote, spec.required_fields, spec.default_currency) == (True, '"', (), None)


def test_date_type_defaults_to_timestamp():
    spec = FeedSpec.of({**FEED, "date_fields": {"id": {"target": "t", "format": "yyyy"}}})
    assert spec.date_fields["id"].type == "timestamp"


def test_empty_sections_count_as_absent():
    assert FeedSpec.of({**FEED, "int_fields": None, "required_fields": None}).int_fields == {}


@pytest.mark.parametrize(
    ("change", "expected"),
    [
        ({"file": None}, "file is missing"),
        ({"columns": []}, "columns is missing"),
        ({"columns": ["id", "ID"]}, "listed twice"),
        ({"int_fields": {"age": "age"}}, "int_fields reads unknown column 'age'"),
        ({"required_fields": ["amount"]}, "required field 'amount' is never produced"),
        ({"special_transform": "nope"}, "not registered"),
        ({"boolean_fields": {"flag": {"target": "f", "true_values": [True], "false_values": []}}}, "quoted text"),
        ({"boolean_fields": {"flag": {"target": "f"}}}, "malformed"),
        ({"columns": ["id", "_raw"]}, "column '_raw' has a reserved name"),
        ({"columns": ["id", "_Rejected"]}, "reserved name"),
        ({"columns": ["id", "_client_id"]}, "reserved name"),
        ({"column_map": {"id": "_quarantine_reason"}}, "target '_quarantine_reason' is a reserved name"),
        ({"column_map": {"id": "x", "name": "X"}}, "target 'X' is made twice"),
        ({"column_map": {"id": "n"}, "int_fields": {"flag": "n"}}, "'flag' replaces what was there"),
        ({"require_fields": ["id"]}, "unknown key 'require_fields'"),
        ({"date_fields": {"id": {"target": "d", "format": "yyyy", "type": "dat"}}}, "type 'dat' is none of"),
        ({"date_fields": {"id": {"target": "d", "format": "YYYY-MM-dd"}}}, "letter 'Y'"),
        ({"date_fields": {"id": {"target": "d", "format": "yyyy-MM-dd'T"}}}, "quote that does not end"),
        ({"date_fields": {"id": {"target": "d", "format": "yyyy[-MM"}}}, "bracket"),
        ({"date_fields": {"id": {"target": "d", "format": "ddd.MM.yyyy"}}}, "repeats the letter 'd' 3 times"),
        ({"date_fields": {"id": {"target": "d", "format": 5}}}, "is no pattern"),
    ],
)
def test_problems_are_found(change, expected):
    assert any(expected in p for p in feed_problems({**FEED, **change}))


def test_rows_without_an_id_must_be_rejected():
    assert any("lacks 'source_customer_id'" in p for p in feed_problems(FEED, "customers"))
    assert not feed_problems({**FEED, "required_fields": ["source_customer_id"]}, "customers")
    with pytest.raises(ValueError, match="x.customers: required_fields lacks"):
        check_configs({"x": {"customers": FEED}})


def test_a_client_id_column_and_a_constant_currency_are_allowed():
    feed = {**FEED, "columns": ["client_id", "id", "cur"], "default_currency": "CHF"}
    assert not feed_problems({**feed, "column_map": {"cur": "currency", "id": "source_customer_id"}})


@pytest.mark.parametrize("pattern", ["yyyy-MM-dd'T'HH:mm:ss.SSSXXX", "d MMM yy", "[HH:mm][h a]", "''yyyy", "VV", "O", "yyyyDDD"])
def test_patterns_that_spark_can_read(spark, pattern):
    feed = {**FEED, "date_fields": {"id": {"target": "d", "format": pattern}}}
    assert not feed_problems(feed)
    spark.range(1).select(F.try_to_timestamp(F.lit("x1"), F.lit(pattern))).collect()


def test_many_clients_are_checked_quickly():
    configs = {f"client_{i}": {} for i in range(20_000)}
    check_configs(configs)
    with pytest.raises(ValueError, match="client, client_7: keys"):
        check_configs({**configs, "client": {}})


def test_a_step_may_read_what_an_earlier_one_made():
    assert not feed_problems({**FEED, "int_fields": {"source_customer_id": "n"}, "required_fields": ["n"]})


def test_transform_outputs_are_known():
    feed = {**FEED, "special_transform": "split_full_name", "required_fields": ["first_name"]}
    assert not feed_problems(feed)


def test_unknown_transform_outputs_are_not_guessed(monkeypatch):
    monkeypatch.setattr(transforms, "TRANSFORMS", transforms.TRANSFORMS)
    transforms.register_transform("anything", lambda df: df)
    try:
        assert not feed_problems({**FEED, "special_transform": "anything", "required_fields": ["whatever"]})
    finally:
        del transforms.TRANSFORMS["anything"]


def test_all_problems_are_reported_at_once():
    configs = copy.deepcopy(CONFIGS)
    configs["client_a"]["client_id"] = "other"
    configs["client_b"]["customers"]["columns"] = []
    configs["client_a_1"] = {}
    with pytest.raises(ValueError) as err:
        check_configs(configs)
    for part in ("file name decides", "client_b.customers: columns is missing", "client_a, client_a_1"):
        assert part in str(err.value)


def test_spec_objects_are_accepted():
    spec = FeedSpec.of({**FEED, "required_fields": ["source_customer_id"]})
    assert check_configs({"7": {"client_id": 7, "customers": spec}}) == {"7": ["customers"]}


def test_other_sections_are_ignored():
    assert check_configs({"x": {"products": {}}}) == {"x": []}
