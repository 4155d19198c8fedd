"""Toxicity: what is hidden is read, and held-out labels are met."""

import random
import time
from collections import Counter
from math import log

import pytest

from feedworks.llm.toxicity import SYMBOLS, CharacterModel, Reader, ToxicityModel, lattice, learn, score, symbol

CLEAN = [a + b for a in ("ther", "an", "on", "in", "tion", "er", "st") for b in ("ing", "ed", "nd", "at", "ou", "ly")]
BAD = ["idiot", "moron", "scum"]


def texts(n, seed=1):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        toxic = i % 5 == 0
        words = draw.choices(CLEAN, k=draw.randint(5, 60)) + (draw.choices(BAD, k=draw.randint(1, 3)) if toxic else [])
        draw.shuffle(words)
        rows.append((i, " ".join(words), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def model(spark):
    df = spark.createDataFrame(texts(600), "doc_id long, text string, toxic int")
    return learn(df.select("doc_id", "text"), df.select("doc_id", "toxic"))


HIDDEN = ["1d10t", "!d!ot", "i d i o t", "i.d.i.o.t", "idiiiiot", "m0r0n", "s-c-u-m", "5cum", "1 d 1 o t"]
#: Several of the channel's changes at once.
HIDDEN += ["i d ! o t", "i  d  i  o  t", "ii dd ii oo tt", "i - d - i - o - t", "iiddiioott", "1..d..1..0..t", "m 0 rr 0 n", "ss-cc-uu-mm"]


@pytest.mark.parametrize("hidden", HIDDEN)
def test_disguises_are_read(model, hidden):
    reader = Reader(model)
    text = f"thering aned {hidden} onnd."
    assert any(word in reader.restored(text) for word in BAD)
    assert reader.score(text) > 0.5 > reader.score("thering aned tioning onnd.")


def test_plain_texts_have_one_reading(model):
    reader = Reader(model)
    for text in ("the thering, aned. onnd 42 times", "é à la", "", "a b", "x y"):
        assert reader.restored(text) == text.lower()


def brute(model, piece):
    best = (float("-inf"), "")
    paths = [(0.0, "")]
    for options in lattice(piece):
        paths = [(p + cost, read + text) for p, read in paths for text, cost in options]
    for p, read in paths:
        known = "  " + "".join(" " if c in " .-_*" else symbol(c) for c in read) + " "
        p += sum(model.log_p(known[i : i + 3]) for i in range(len(known) - 2))
        best = max(best, (p, read))
    return best


@pytest.mark.parametrize("piece", ["1d10t", "m0r0n5", "a b c d", "i.d.i.o.t", "4nnnd", "th3r1ng", "42", "aaa", "5+4r", "aa bb ii", "i - d", "i d ! o", "iiddoo"])
def test_viterbi_finds_the_best_path(model, piece):
    characters = CharacterModel(model.trigrams)
    p, read = brute(characters, piece)
    assert characters.restore(piece) == read


def test_held_out_texts(spark, model):
    df = spark.createDataFrame(texts(300, seed=9), "doc_id long, text string, score int")
    rows = score(df, model, out="p").collect()
    assert all((r["p"] >= 0.3) == bool(r["score"]) for r in rows)


def test_nulls_no_labels_one_label_and_empty(spark, model):
    schema = "doc_id long, text string, score string"
    df = spark.createDataFrame([(1, None, "old"), (2, "", "old"), (None, "x" * 100_000 + "1y", "old")], schema)
    got = [r["score"] for r in score(df, model).collect()]
    assert got[0] == got[1] and all(0 <= x <= 1 for x in got)
    assert score(df, model).columns == df.columns
    assert score(df.limit(0), model).count() == 0
    none = learn(df, spark.createDataFrame([], "doc_id long, toxic int"))
    assert none == ToxicityModel() and none.score_all(["a"]).tolist() == [0.0]
    labels = spark.createDataFrame([(1, 0), (2, 0), (2, None), (None, 1), (77, 1)], "doc_id long, toxic int")
    one = learn(df, labels)
    assert one.intercept == pytest.approx(log(0.5 / 2.5)) and not one.weights


def test_the_classifier_learns_from_a_bounded_sample_and_the_character_model_from_all(spark):
    rows = texts(200)
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    few = learn(df.select("doc_id", "text"), df.select("doc_id", "toxic"), sample=10)
    many = learn(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    assert not few.weights and many.weights
    want = Counter()
    for _, text, _ in rows:
        for word in text.split():
            framed = "".join(map(symbol, word)).join(("  ", " "))
            want.update(framed[i : i + 3] for i in range(len(framed) - 2))
    assert few.trigrams == many.trigrams == want


def test_trigrams_of_odd_texts(spark):
    rows = [(1, "Été  à\n1st\t", 0), (2, None, 1), (3, "", 0), (4, "漢字 ы", 1), (5, " a ", 0), (6, "b", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    got = learn(df.select("doc_id", "text"), df.select("doc_id", "toxic")).trigrams
    want = Counter()
    for _, text, _ in rows:
        for word in (text or "").lower().split():
            framed = "".join(map(symbol, word)).join(("  ", " "))
            want.update(framed[i : i + 3] for i in range(len(framed) - 2))
    assert got == want and len(SYMBOLS) == 64


@pytest.mark.parametrize("body", ["漢字仮名", "abcdefgh", "xy1", "a1", "aab", "a-b-", "é"])
def test_long_runs_take_time_in_proportion(model, body):
    """A million characters without a space, and one sign of the channel far from them or amid them."""
    reader = Reader(model)
    run = (body * (1_000_000 // len(body) + 1))[:1_000_000]
    begin = time.perf_counter()
    got = reader.restored(run + " x1d")
    reader.restored("x1d " + run + "1d" + run[:1000])
    assert time.perf_counter() - begin < 60
    if body in ("漢字仮名", "abcdefgh"):
        assert got.startswith(run)


def test_long_words_are_features(spark):
    word = "w" + "xyz" * 20
    rows = [(i, f"the {word if i % 4 == 0 else 'other'} text {i}", int(i % 4 == 0)) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    found = learn(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    assert word + "$" in found.weights
