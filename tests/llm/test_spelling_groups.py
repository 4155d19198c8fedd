"""Spelling groups against comparing all pairs of words."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from feedworks.llm import spelling_groups
from feedworks.llm.queries import QUERIES
from feedworks.llm.spelling_groups import RUN, count_runs, group_spellings, near_in_block, near_words, one_edit

COUNTS = "word string, n long"


def edits(a, b):
    """Whether the edit distance is one, by the table."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1] == 1


def plain(counts, ratio=10, least=7):
    words = {w: n for w, n in counts.items() if len(w) >= least}
    near = {w: [v for v in words if edits(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {w: (form[w], root(w), words[w], len(near[w]), form[w] and words[form[w]]) for w in words}


def found(spark, counts, **settings):
    df = group_spellings(spark.createDataFrame(list(counts.items()), COUNTS), **settings)
    return {r["word"]: tuple(r)[1:] for r in df.collect()}


def vocabulary(seed, letters, n=150, shortest=7, longest=11):
    draw = random.Random(seed)
    words = {}
    for _ in range(n):
        word = "".join(draw.choices(letters, k=draw.randint(shortest, longest)))
        words[word] = draw.choice([2, 3, 20, 40, 300, 5000])
        for _ in range(draw.randrange(4)):
            at, kind = draw.randrange(len(word)), draw.randrange(3)
            other = word[:at] + draw.choice(["", draw.choice(letters), word[at] + draw.choice(letters)][kind:] or [""]) + word[at + 1 :]
            words.setdefault(other, draw.choice([2, 2, 30, 200]))
    return words


def test_one_edit():
    draw = random.Random(1)
    for _ in range(20_000):
        a, b = ("".join(draw.choices("ab", k=draw.randrange(6))) for _ in range(2))
        assert one_edit(a, b) == edits(a, b), (a, b)


@pytest.mark.parametrize("seed, letters", [(1, "ab"), (2, "abcdefghijklmnop"), (3, "aàéñz"), (4, "abc")])
def test_equals_all_pairs(spark, seed, letters):
    counts = vocabulary(seed, letters)
    assert found(spark, counts) == plain(counts)


@pytest.mark.parametrize("block", [1, 2, 16])
def test_full_blocks_are_dealt_again(spark, monkeypatch, block):
    """Words that nearly all share their halves, with blocks too small for them."""
    monkeypatch.setattr(spelling_groups, "BLOCK", block)
    counts = vocabulary(5, "ab", n=60) | vocabulary(6, "ab", n=60, shortest=14, longest=20)
    counts |= {"prefixed" + w: n for w, n in vocabulary(7, "abc", n=40, shortest=1, longest=4).items()}
    assert found(spark, counts) == plain(counts)


def test_blocks_stay_small_where_a_third_share_a_half(spark):
    draw = random.Random(2)
    words = {"common" + "".join(draw.choices("abcdefghij", k=8)): 2 for _ in range(4000)}
    words |= {"".join(draw.choices("klmnopqrst", k=12)): 2 for _ in range(4000)}
    df = spark.createDataFrame(list(words.items()), COUNTS)
    sizes = [r["count"] for r in spelling_groups._blocks(df).groupBy("block").count().collect()]
    assert max(sizes) <= spelling_groups.BLOCK and sum(sizes) <= 8 * len(words)


def test_the_gram_matrix_keeps_every_near_pair():
    draw = random.Random(3)
    words = list(vocabulary(8, "abcé"))
    blocks = np.array([draw.randrange(2) for _ in words])
    i, j = near_in_block(words, blocks)
    got = {(words[a], words[b]) for a, b in zip(i, j)}
    pairs = [(a, b) for a in range(len(words)) for b in range(a + 1, len(words)) if blocks[a] == blocks[b]]
    assert got == {(words[a], words[b]) for a, b in pairs if edits(words[a], words[b])}
    # Letters whose numbers agree in their last byte count as one and are told apart afterwards.
    assert [x.tolist() for x in near_in_block(["aaaaaaa", "aaaaaaš", "aaaaaaaa"], np.zeros(3))] == [[0, 0], [1, 2]]


def test_very_long_words(spark):
    long = "ab" * 1050
    counts = {long: 100, long[:-1] + "c": 2, long[1:]: 3, "c" * 7: 2}
    assert found(spark, counts) == plain(counts)


def test_ties_chains_and_roots(spark):
    counts = {"aaaaaaa": 2, "aaaaaab": 20, "aaaaaac": 20, "aaaaabb": 200, "aaaabbb": 2000, "zzzzzzz": 9, "zzzzzzy": 89, "short": 5}
    got = found(spark, counts)
    assert got == plain(counts)
    assert got["aaaaaaa"][:2] == ("aaaaaab", "aaaabbb")  # of two equally frequent ones the smaller
    assert got["zzzzzzz"][:2] == (None, "zzzzzzz")  # not ten times as frequent


def test_nulls_repeats_empty_and_other_columns(spark):
    rows = [("aaaaaaa", 1, "x"), ("aaaaaaa", 1, "y"), (None, 5, ""), ("bbbbbbb", None, ""), ("aaaaaab", 20, "")]
    df = spark.createDataFrame(rows, COUNTS + ", form string")
    got = {r["word"]: tuple(r)[1:] for r in group_spellings(df).collect()}
    assert got == {"aaaaaaa": ("aaaaaab", "aaaaaab", 2, 1, 20), "aaaaaab": (None, "aaaaaab", 20, 1, None)}
    assert group_spellings(df.limit(0)).count() == 0
    assert group_spellings(df.where("word = 'bbbbbbb'")).count() == 0
    assert near_words(df.limit(0).select("word", "n")).count() == 0


def typed(docs, least=7, drop=31):
    seen = Counter()
    for doc, text in docs:
        for run in RUN.findall(text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'null' if doc is None else doc}:{run}".encode())
            if drop and h % drop == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least:
                seen[run] += 1
    return seen


@pytest.mark.parametrize("drop", [None, 2, 31])
def test_runs_are_counted_with_their_typing_errors(spark, monkeypatch, drop):
    monkeypatch.setattr(spelling_groups, "HELD", 20)
    draw = random.Random(4)
    words = ["Sentence", "ÉCOLEàÀ", "straße", "ordinary", "x×y÷zzz", "ORDINARY", "ordinarily", "Ünïcode", "日本語sevenletters", "a" * 40]
    docs = [(i, draw.choice([" ", ", ", "7"]).join(draw.choices(words, k=30))) for i in range(80)]
    docs += [(None, "Sentence ordinary"), (3, None), (4, ""), (5, "1234 --"), (-6, "Sentence " * 50_000)] + docs[:5]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["word"]: r["n"] for r in count_runs(df, "doc_id", "text", 7, drop).collect()}
    assert got == typed(docs, drop=drop)


def test_registered_query(spark, tmp_path):
    draw = random.Random(5)
    words = [w for w, n in vocabulary(9, "abcdé", n=60).items() for _ in range(n if n < 50 else 60)]
    draw.shuffle(words)
    docs = [(i, " ".join(words[i * 40 : i * 40 + 40])) for i in range(len(words) // 40)] + [(None, None)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    df = QUERIES["op12_spelling_groups"](spark, str(tmp_path))
    assert df.dtypes == [
        ("word", "string"), ("form", "string"), ("root", "string"), ("n", "bigint"), ("n_near", "bigint"), ("form_n", "bigint")
    ]
    want = plain({w: n for w, n in typed(docs).items() if n >= 2})
    assert {r["word"]: tuple(r)[1:] for r in df.collect()} == want and any(v[0] for v in want.values())
