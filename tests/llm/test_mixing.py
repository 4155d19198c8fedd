"""Mixing against sharing step by step."""

import hashlib
from collections import Counter

import pytest

from feedworks.llm.mixing import mix, mix_plan


def drawn(cells, number=0, seed=0) -> float:
    """The draw of a row with these cells, the ``number``-th of its equals."""
    digest = hashlib.md5("\x01".join("\x02" if c is None else str(c) for c in cells).encode()).hexdigest()
    return int(hashlib.md5(f"{seed}:{digest}:{number}".encode()).hexdigest()[:13], 16) / 2**52


def shared(sizes: dict, weights=(5, 2, 1), ceiling=3.0) -> dict:
    """Targets by repeated sharing: whoever is above the ceiling is set to it, the rest shared again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, target = float(sum(sizes.values())), set(order), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > ceiling * sizes[s]}
        if not full:
            target |= {s: level * weight[s] for s in open_}
            break
        target |= {s: ceiling * sizes[s] for s in full}
        left -= sum(ceiling * sizes[s] for s in full)
        open_ -= full
    return target


CASES = [
    {"a": 100, "b": 100, "c": 100},
    {"a": 1, "b": 1000, "c": 3},
    {"a": 1, "b": 2, "c": 3, "d": 4000, None: 5},
    {"é": 10, "Z": 10, "a": 0, "": 70},
    {"only": 17},
    {"nothing": 0},
]


@pytest.mark.parametrize("sizes", CASES)
def test_targets_equal_repeated_sharing(spark, sizes):
    rows = [(i, "w " * n, s, "old") for i, (s, n) in enumerate(sizes.items())]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, target string")
    want = shared(sizes)
    for r in mix_plan(df).collect():
        assert r["target"] == pytest.approx(want[r["source"]])
        assert r["size"] == r["source_size"] == sizes[r["source"]]
        assert r["copies"] <= 3


def test_taken_words_come_near_targets_and_reruns_agree(spark):
    rows = [(i, "w " * (1 + i % 50), f"s{i % 3 if i % 10 < 5 else 0}") for i in range(20_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = mix_plan(df).collect()
    taken, target = Counter(), {}
    for r in plan:
        taken[r["source"]] += r["copies"] * r["size"]
        target[r["source"]] = r["target"]
        rate = r["target"] / r["source_size"]
        draw = drawn((r["doc_id"], r["text"], r["source"]))
        assert r["copies"] == int(rate) + (draw < rate - int(rate))
    for s in target:
        assert taken[s] == pytest.approx(target[s], rel=0.05)
    again = mix_plan(df.repartition(7)).collect()
    assert {r["doc_id"]: r["copies"] for r in again} == {r["doc_id"]: r["copies"] for r in plan}
    emitted = Counter(r["doc_id"] for r in mix(df).collect())
    assert emitted == Counter({r["doc_id"]: r["copies"] for r in plan if r["copies"]})


def test_more_sources_than_are_broadcast(spark, monkeypatch):
    rows = [(i, "w " * (1 + i % 5), f"s{i % 7}" if i % 8 else None) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    key = lambda r: (r["doc_id"], r["size"], r["target"], r["copies"])
    want = sorted(map(key, mix_plan(df).collect()))
    monkeypatch.setattr("feedworks.llm.mixing.BROADCAST_SOURCES", 2)
    assert sorted(map(key, mix_plan(df).collect())) == want


def test_nulls_clashing_columns_and_empty(spark):
    schema = "doc_id long, text string, source string, size string, copies int, mix_row int, mix_copy int"
    rows = [(None, None, None, "s", 9, 1, 2), (1, "a b", None, "t", 9, 1, 2), (1, "a b", None, "t", 9, 1, 2)]
    df = spark.createDataFrame(rows, schema)
    mixed = mix(df).collect()
    assert mixed and all(tuple(r) in rows for r in mixed)
    assert mix(df).columns == df.columns
    assert mix(df.limit(0)).count() == 0 and mix_plan(df.limit(0)).count() == 0


def taken_of_target(df, **settings):
    taken, target = Counter(), {}
    for r in mix_plan(df, **settings).collect():
        taken[r["source"]] += r["copies"] * r["size"]
        target[r["source"]] = r["target"]
    return {s: taken[s] / target[s] for s in target if target[s]}


@pytest.mark.parametrize("name", [lambda i: None, lambda i: i % 10, lambda i: 7])
def test_null_and_repeated_ids_come_near_targets(spark, name):
    rows = [(name(i), f"text {i}" + " w" * (i % 9), f"s{i % 3 if i % 10 < 5 else 0}") for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for ratio in taken_of_target(df).values():
        assert ratio == pytest.approx(1, abs=0.06)


@pytest.mark.parametrize("few", [True, False])
def test_equal_rows_draw_by_their_number(spark, monkeypatch, few):
    """A third of all rows is one row, repeated: it is taken as often as its rate says, the same way every time."""
    monkeypatch.setattr("feedworks.llm.mixing.EQUAL_ROWS", 64)
    if not few:
        monkeypatch.setattr("feedworks.llm.mixing.BROADCAST_KINDS", 0)
    same = [(1, "one two", "a")] * 2000 + [(None, None, None)] * 50 + [(2, "three", "b")] * 2
    rows = same + [(i, f"w{i} x", "b" if i % 4 else "c") for i in range(10, 4010)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = mix_plan(df).collect()
    assert Counter((r["doc_id"], r["text"], r["source"]) for r in plan) == Counter(rows)
    of = {r["source"]: r["target"] / r["source_size"] for r in plan if r["source_size"]}
    want = Counter()
    for row, n in Counter(rows).items():
        rate = of.get(row[2], 0)
        for number in range(n):
            want[row, int(rate) + (drawn(row, number) < rate - int(rate))] += 1
    assert Counter(((r["doc_id"], r["text"], r["source"]), r["copies"]) for r in plan) == want
    again = mix_plan(df.repartition(5)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, plan))
    for ratio in taken_of_target(df).values():
        assert ratio == pytest.approx(1, abs=0.06)


def test_a_ceiling_that_is_no_whole_number(spark):
    rows = [(i, f"word {i}", "small" if i % 50 == 0 else "large") for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = mix_plan(df, weights=(1, 5), ceiling=2.5)
    assert {r["source"]: r["target"] / r["source_size"] for r in plan.collect()}["small"] == pytest.approx(2.5)
    assert taken_of_target(df, weights=(1, 5), ceiling=2.5)["small"] == pytest.approx(1, abs=0.1)
    assert plan.agg({"copies": "max"}).first()[0] == 3


def test_very_long_texts_are_counted_whole(spark):
    df = spark.createDataFrame([(1, "w " * 2_000_000, "a"), (2, "x" * 5_000_000, "a")], "doc_id long, text string, source string")
    assert {r["doc_id"]: r["size"] for r in mix_plan(df).select("doc_id", "size").collect()} == {1: 2_000_000, 2: 1}
