"""Formatted chats read back as what they were made of."""

import time

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedworks.llm.chat_format import format_chats, read_loss, read_turns

SCHEMA = "conv_id long, turn long, role string, text string"
nasty = st.lists(
    st.sampled_from(["\\", "<", "#", "/", "turn>", "part/>", "\n", ":", "###", " ", "h", "l", "b", "c", "user", "é"]), max_size=8
).map("".join)
roles = st.one_of(st.sampled_from(["user", "assistant"]), nasty)


def read(df):
    chats = format_chats(df)
    return chats.select(
        "conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"),
        read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    ).collect()


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5), roles, nasty), max_size=25))
def test_any_turns_can_be_read_back(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    want = {}
    for conv, turn, role, text in sorted(rows):
        want.setdefault(conv, []).append((role, text))
    got = read(df)
    assert {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in got} == want
    assert {r["conv_id"]: r["loss"] for r in got} == {k: [t for r, t in v if r == "assistant"] for k, v in want.items()}


def test_blocks_marks_and_nulls(spark):
    rows = [
        (1, 2, "assistant", "b <x>"), (1, 0, "user", "a"), (1, 1, "user", "a2"), (1, 3, "assistant", ""),
        (2, None, None, None), (2, 0, "assistant", "y"), (2, 0, "assistant", "y"), (None, 5, "user", "z"),
    ]
    found = {r["conv_id"]: r for r in read(spark.createDataFrame(rows, SCHEMA))}
    assert found[1]["formatted"] == "### user:\na<part/>a2</turn>\n### assistant:\nb \\lx><part/></turn>\n"
    assert found[1]["loss"] == ["b <x>", ""]
    assert [tuple(t) for t in found[2]["turns"]] == [("", ""), ("assistant", "y"), ("assistant", "y")]
    assert [tuple(t) for t in found[None]["turns"]] == [("user", "z")]


def test_long_conversation_other_columns_and_empty(spark):
    rows = [(1, i, "user" if i % 3 else "assistant", f"text {i} " * 50, "x") for i in range(2000)]
    df = spark.createDataFrame(rows, SCHEMA + ", formatted string")
    (r,) = read(df)
    assert [t["text"] for t in r["turns"]] == [row[3] for row in rows]
    assert "".join(r["loss"]) == "".join(row[3] for row in rows if row[2] == "assistant")
    assert read(df.limit(0)) == []


def test_time_follows_the_number_of_turns(spark):
    """Four times the turns take about four times as long, not sixteen."""

    def seconds(turns):
        rows = spark.range(turns).select(
            F.lit(1).alias("conv_id"),
            F.col("id").alias("turn"),
            F.when(F.col("id") % 3 == 0, "user").otherwise("assistant").alias("role"),
            F.concat(F.lit("text <"), "id").alias("text"),
        )
        begin = time.perf_counter()
        spans, chars = format_chats(rows).select(F.size("loss_spans"), F.length("formatted")).first()
        assert spans == turns - -(-turns // 3) and chars > 12 * turns
        return time.perf_counter() - begin

    seconds(1000)
    assert seconds(40_000) < 4 + 8 * seconds(10_000)
