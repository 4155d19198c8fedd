"""Removing earlier documents' passages against looking at every window."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from feedworks.llm import suffix_shards
from feedworks.llm.queries import QUERIES
from feedworks.llm.suffix_shards import SuffixAutomaton, earlier_windows, remove_earlier_passages

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(rows, window):
    """The kept text, number of words and removed spans of each (doc_id, text)."""
    split = [WORD.findall(text or "") for _, text in rows]
    first = {}
    for (doc, _), words in zip(rows, split):
        for i in range(len(words) - window + 1):
            if doc is not None:
                w = tuple(words[i : i + window])
                first[w] = min(first.get(w, doc), doc)
    out = []
    for (doc, _), words in zip(rows, split):
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            if doc is not None and first[tuple(words[i : i + window])] < doc:
                gone[i : i + window] = [True] * window
        spans, at = [], 0
        while at < len(words):
            to = at
            while to < len(words) and gone[to] == gone[at]:
                to += 1
            if gone[at]:
                spans.append((at, to))
            at = to
        out.append((doc, " ".join(w for w, g in zip(words, gone) if not g), len(words), sum(gone), spans))
    return sorted(out, key=repr)


def found(spark, rows, window):
    df = remove_earlier_passages(spark.createDataFrame(rows, "doc_id long, text string"), window=window)
    return sorted(
        ((r["doc_id"], r["text"], r["n_words"], r["n_removed"], [tuple(s) for s in r["removed"]]) for r in df.collect()),
        key=repr,
    )


def corpus(seed, words, documents=60, most=60):
    """Documents that take passages from each other, ids in any order, some null or repeated."""
    draw = random.Random(seed)
    rows = []
    ids = draw.sample(range(1000), documents)
    for i in ids:
        text = draw.choices(words, k=draw.randrange(most))
        for _ in range(draw.randrange(3)):
            if rows:
                other = WORD.findall(draw.choice(rows)[1])
                a = draw.randrange(len(other) + 1)
                text[draw.randrange(len(text) + 1) : 0] = other[a : a + draw.randrange(40)]
        rows.append((i, draw.choice([" ", "\n", "\t ", "  "]).join(text)))
    rows += [draw.choice(rows) for _ in range(5)]  # repeated rows
    rows += [(rows[0][0], rows[3][1]), (rows[1][0], rows[4][1] + " end")]  # repeated ids
    rows += [(None, rows[2][1]), (None, rows[2][1]), (5000, None), (5001, ""), (-3, " \n"), (-4, rows[7][1])]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, window, vocabulary", [(1, 13, 400), (2, 13, 3), (3, 4, 6), (4, 2, 5), (5, 7, 40)])
def test_equals_looking_at_every_window(spark, seed, window, vocabulary):
    rows = corpus(seed, [f"w{i}" for i in range(vocabulary)])
    got = found(spark, rows, window)
    assert got == plain(rows, window) and any(r[3] for r in got)


@pytest.mark.parametrize("chunk, shard, heavy", [(200, 10, 2), (1, 1, 0), (1 << 20, 1000, 5)])
def test_sizes_change_nothing(spark, monkeypatch, chunk, shard, heavy):
    """Small chunks and shards, and marks that are all cut into windows."""
    for name, value in (("CHUNK", chunk), ("SHARD", shard), ("HEAVY", heavy)):
        monkeypatch.setattr(suffix_shards, name, value)
    rows = corpus(6, [f"w{i}" for i in range(30)])
    assert found(spark, rows, 6) == plain(rows, 6)


def test_a_passage_in_a_third_of_all_documents(spark, monkeypatch):
    monkeypatch.setattr(suffix_shards, "HEAVY", 20)
    monkeypatch.setattr(suffix_shards, "CHUNK", 2000)
    draw = random.Random(8)
    common, line = [f"c{i}" for i in range(60)], ["a", "very", "common", "line", "of", "words"]
    rows = []
    for i in range(400):
        words = draw.choices([f"w{k}" for k in range(3000)], k=40)
        words[20:20] = common if i % 3 == 0 else line if i % 3 == 1 else []
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, rows[5][1]) for i in range(100)]
    assert found(spark, rows, 13) == plain(rows, 13)


def test_the_automaton_knows_every_substring():
    draw = random.Random(3)
    for _ in range(200):
        known = [[draw.choice([b"a", b"b", b"c"]) for _ in range(draw.randrange(12))] for _ in range(draw.randrange(5))]
        automaton = SuffixAutomaton()
        for words in known:
            automaton.add(words)
        parts = {tuple(w[i:j]) for w in known for i in range(len(w)) for j in range(i + 1, len(w) + 1)}
        asked = [draw.choice([b"a", b"b", b"c", b"d"]) for _ in range(15)]
        want = [max((n for n in range(1, i + 2) if tuple(asked[i + 1 - n : i + 1]) in parts), default=0) for i in range(15)]
        assert automaton.statistics(asked) == want


def test_only_smaller_documents_count():
    one, two = b"a b c d", b"x a b c"
    assert earlier_windows([(1, one), (2, two)], 3) == {two: bytes([1])}
    assert earlier_windows([(1, one), (1, two)], 3) == {}
    assert earlier_windows([(2, one), (1, two)], 3) == {one: bytes([0])}


def test_a_very_long_text(spark):
    draw = random.Random(4)
    long = [f"w{draw.randrange(100_000)}" for _ in range(300_000)]
    rows = [(2, " ".join(long)), (1, " ".join(long[150_000:150_030])), (3, "x" * 3_000_000)]
    got = {r[0]: r[2:] for r in found(spark, rows, 13)}
    assert got == {1: (30, 0, []), 2: (300_000, 30, [(150_000, 150_030)]), 3: (1, 0, [])}


def test_other_columns_pass_and_results_give_way(spark):
    schema = (
        "n_words string, `odd name` int, doc_id long, text string, chunk int, row string, REMOVED int, deep struct<text:string,a:array<int>>"
    )
    text = " ".join(f"w{i}" for i in range(20))
    rows = [("n", 7, 1, text, 1, "r", 2, ("t", [1])), (None, None, 2, text + " end", None, None, None, None)]
    df = remove_earlier_passages(spark.createDataFrame(rows, schema))
    names = [f.split()[0].strip("`") for f in ("n_words", "`odd", "doc_id")]
    assert df.columns[0] == names[0] and df.columns[1] == "odd name"
    assert df.columns[8:] == ["_n_words", "n_removed", "_removed"]
    got = {r["doc_id"]: r for r in df.collect()}
    assert tuple(got[1])[:8] == rows[0] and tuple(got[2])[4:8] == (None,) * 4
    assert (got[2]["text"], got[2]["_n_words"], got[2]["n_removed"]) == ("end", 21, 20)


def test_empty_tables_and_bad_windows(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert remove_earlier_passages(df).count() == 0
    assert remove_earlier_passages(spark.createDataFrame([(1, None)], "doc_id long, text string")).first()["text"] == ""
    for window in (1, 201):
        with pytest.raises(ValueError, match="2 to 200"):
            remove_earlier_passages(df, window=window)


def test_registered_query(spark, tmp_path):
    rows = corpus(9, [f"w{i}" for i in range(50)])
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_words", F.lit("clash"))
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op11_suffix_shards"](spark, str(tmp_path))
    assert got.dtypes == [("doc_id", "bigint"), ("n_words", "bigint"), ("n_removed", "bigint"), ("kept_sha256", "string")]
    want = [(d, n, r, hashlib.sha256(t.encode()).hexdigest()) for d, t, n, r, _ in plain(rows, 13)]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
