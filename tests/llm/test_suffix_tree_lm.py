"""The suffix tree model against plain counting, and its distributions against one."""

import random
import re
import zlib
from collections import Counter, defaultdict
from math import log, log10

import pytest

from feedworks.llm import suffix_tree_lm as lm

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return WORD.findall((text or "").translate(LOWER)) + [None]


def is_held(doc):
    return zlib.crc32(("" if doc is None else str(doc)).encode()) % 10 == 0


class Plain:
    """The model by dictionaries, as its definition says."""

    def __init__(self, rows, depth):
        train = [tokens(t) for d, t in rows if not is_held(d)]
        self.c = Counter(x for t in train for x in t)
        self.N, self.V = sum(self.c.values()), len(self.c)
        self.states, frequent = {(): None}, None
        following = defaultdict(Counter)
        for t in train:
            for i in range(len(t)):
                for k in range(1, min(depth, i) + 1):
                    following[tuple(t[i - k : i])][t[i]] += 1
        for k in range(1, depth + 1):
            for s in [s for s in following if len(s) == k]:
                # A longer context is tried only where its suffix is a state.
                if s[1:] not in self.states or self.times(following, s) < lm.LEAST:
                    continue
                counts = following[s]
                rare = sum(n for x, n in counts.items() if self.c[x] < 2)
                own = {x: n for x, n in counts.items() if self.c[x] >= 2}
                total = rare + sum(own.values())
                rest = (lm.DISCOUNT * len(own) + rare) / total
                gain = sum(n * (log(n - 1) - log(total) - log(2) * round(8 * self.bits(x, s[1:])) / -8)
                           for x, n in own.items() if n >= 2)
                once = rare + sum(n == 1 for n in own.values())
                gain += once * log(min(rest, 1)) if once else 0
                if total >= lm.LEAST and gain > lm.GAIN:
                    self.states[s] = (own, total, rest)

    def times(self, following, s):
        if len(s) == 1:
            return self.c[s[0]]
        # As a key of the context before, which must have been tried itself.
        before = s[:-1]
        tried = before[1:] in self.states and self.times(following, before) >= lm.LEAST
        return following[before][s[-1]] if tried and self.c[s[-1]] >= 2 else 0

    def bits(self, x, context):
        return min(255 / 8, -log(self.p(x, context)) / log(2))

    def p(self, x, context):
        root = (self.c[x] + 0.1) / (self.N + 0.1 * (self.V + 1))
        p = root
        for k in range(1, len(context) + 1):
            s = context[len(context) - k :]
            if s not in self.states:
                break
            own, total, rest = self.states[s]
            p = max(own.get(x, 0) - lm.DISCOUNT, 0) / total + rest * p
        return p

    def score(self, text, depth):
        t = tokens(text)
        return sum(log10(self.p(t[i], tuple(t[max(0, i - depth) : i]))) for i in range(len(t)))

    def base(self, text):
        return sum(log10((self.c[x] + 0.1) / (self.N + 0.1 * (self.V + 1))) for x in tokens(text))


def corpus(seed, n=150):
    draw = random.Random(seed)
    words = [f"W{i}" for i in range(60)]
    chain = {w: draw.choices(words, k=3) for w in words}
    rows = []
    for i in range(n):
        w, text = draw.choice(words), []
        for _ in range(draw.randint(0, 60)):
            text.append(w)
            w = draw.choice(chain.get(w, words)) if draw.random() < 0.8 else draw.choice(words + [f"rare{i}"])
        rows.append((i, draw.choice([" ", "\n", "  \t"]).join(text)))
    rows += [(n + i, rows[i % 7][1].lower()) for i in range(30)]
    return rows + [(n + 40, None), (n + 41, ""), (None, "W1 W2 é")]


@pytest.mark.parametrize("chunk, bucket, hot", [(1 << 20, 1 << 20, 1 << 16), (200, 300, 1 << 16), (200, 300, 5)])
def test_equals_plain_counting(spark, monkeypatch, chunk, bucket, hot):
    monkeypatch.setattr(lm, "CHUNK", chunk)
    monkeypatch.setattr(lm, "BUCKET", bucket)
    make = lm.Corpus.__init__

    def small(self, *args):
        make(self, *args)
        self.hot = hot

    monkeypatch.setattr(lm.Corpus, "__init__", small)
    rows = corpus(1)
    df = spark.createDataFrame([(d, t, 1.0) for d, t in rows], "doc_id long, text string, score double")
    got = {r["doc_id"]: r for r in lm.score(df.repartition(3)).collect()}
    assert len(got) == len(rows)
    plain = Plain(rows, lm.DEPTH)
    assert len([s for s in plain.states if len(s) == 2]) > 3
    for d, t in rows:
        r = got[d]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (is_held(d), len(tokens(t)), plain.N)
        assert r["n_known"] == sum(plain.c[x] > 0 for x in tokens(t))
        assert r["base_score"] == pytest.approx(plain.base(t), rel=1e-9)
        assert r["score"] == pytest.approx(plain.score(t, lm.DEPTH), rel=1e-6)
    held = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_probabilities_of_all_words_add_up_to_one():
    plain = Plain(corpus(2), lm.DEPTH)
    words = [*plain.c, "never seen"]
    for state in list(plain.states)[:60]:
        assert sum(plain.p(x, state) for x in words) == pytest.approx(1)


def test_packing():
    import numpy as np

    for kind in (np.uint8, np.uint32, np.uint64, np.float64, np.int32):
        values = np.arange(1000).astype(kind)
        assert lm.unpack(lm.pack(values), kind).tolist() == values.tolist()
        assert lm.unpack(lm.pack(values[:0]), kind).tolist() == []


def test_empty_table_and_no_training_rows(spark):
    df = spark.createDataFrame([(None, "a b"), (None, None)], "doc_id long, text string")
    got = sorted(lm.score(df).collect(), key=lambda r: r["n_tokens"])
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) for r in got] == [(1, 0, 0, True), (3, 0, 0, True)]
    assert got[0]["score"] == got[0]["base_score"] == pytest.approx(0)
    assert lm.score(df.limit(0)).count() == 0


def test_counts_of_the_corpus_have_64_bits():
    import numpy as np
    import pandas as pd

    many, u32 = 3_000_000_000, np.uint32
    corpus = lm.Corpus(1, 100_000_000_000, 2)
    row = lm.chunk_row(1, [1], [False], [np.array([5, 7], lm.U)])
    row = row.to_pylist()[0]
    sent = {"bucket": 0, "chunk": [1, 2], "entries": lm.pack(np.array([5, 7], lm.U))}
    words = lm.add_words(pd.DataFrame(sent | {"counts": lm.pack(np.array([many, 9], u32))}))
    row["answers"] = words[words.chunk == 1][["depth", "bucket", "counts", "states"]].to_dict("records")
    assert lm.replayed(row, corpus, 0).word_seen.tolist() == [2 * many, 18]
    # One context with one next word, which two chunks have seen as often as they can say.
    sent = {"bucket": 0, "chunk": [1, 2], "entries": lm.pack(np.array([5], lm.U)), "counts": lm.pack(np.array([1], u32))}
    sent |= {"lone": lm.pack(np.array([0], u32)), "split": lm.pack(np.zeros(1, lm.U)), "next": lm.pack(np.array([3], u32))}
    sent |= {"seen": lm.pack(np.array([many], u32)), "parent": lm.pack(np.array([80], np.uint8))}
    found = lm.add_up(1)(pd.DataFrame(sent))
    answer = found[found.chunk == 2].iloc[0]
    zero = np.zeros(1, int)
    n, is_state, p = lm.settle(1, corpus, {0: (answer.counts, answer.states)}, np.zeros(1, lm.U), zero, zero, np.array([0.001]))
    assert n.tolist() == [2 * many] and is_state.all()
    assert p[0] == pytest.approx(1, abs=1e-8)
