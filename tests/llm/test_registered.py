"""Registered queries that SQL cannot express, against plain code: columns, types and digests."""

import base64
import hashlib
import random
import zlib
from collections import Counter
from math import log

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from pyspark.sql import functions as F

from feedworks.llm import toxicity
from feedworks.llm.queries import BYTE_PATTERN, BYTE_RANKS, PIECES, QUERIES, TEXT_END, TOXIC_FROM
from feedworks.llm.token_shards import Permutation
from tests.llm.test_suffix_tree_lm import Plain, is_held, tokens
from tests.llm.test_toxicity import BAD, CLEAN

SCHEMA = "doc_id long, text string, source string, n_tokens string, score string"


def documents(n=240, seed=3):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        words = draw.choices(CLEAN + ["The", "THE", "é漢字", "'s"], k=draw.randint(0, 60))
        for _ in range(draw.randint(1, 3) if i % 5 == 0 else 0):
            words.insert(draw.randrange(len(words) + 1), draw.choice([*BAD, "1d10t", "i d i o t"]))
        rows.append((i, draw.choice([" ", "\n", "  "]).join(words), "s", "clash", "clash"))
    rows += [(None, None, None, None, None), (500, "", "s", "", ""), (501, "long " * 40_000, "s", "", ""), rows[7], rows[7]]
    return rows


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    place = str(tmp_path_factory.mktemp("registered"))
    rows = documents()
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{place}/documents.parquet")
    labels = [(r[0], 1, int(r[0] % 5 == 0)) for r in rows[:240]]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{place}/labels.parquet")
    return place


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def test_op1(spark, folder):
    df = QUERIES["op1_sentencepiece"](spark, folder)
    assert df.dtypes == [("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    library, want = sentencepiece.SentencePieceProcessor(model_file=PIECES), []
    for doc, text, *_ in documents():
        ids = library.encode(text or "")
        want.append((doc, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
    assert rows_of(df) == sorted(want, key=repr)


def test_op2(spark, folder):
    df = QUERIES["op2_suffix_tree_lm"](spark, folder)
    assert df.dtypes[:7] == [
        ("doc_id", "bigint"), ("held_out", "boolean"), ("n_tokens", "bigint"), ("n_known", "bigint"),
        ("train_tokens", "bigint"), ("base_score", "double"), ("score", "double"),
    ]
    docs = documents()
    plain = Plain([(d, t) for d, t, *_ in docs], 3)
    want = sorted(
        ((d, is_held(d), len(tokens(t)), sum(plain.c[x] > 0 for x in tokens(t)), plain.N, plain.base(t), plain.score(t, 3))
         for d, t, *_ in docs), key=lambda r: (repr(r[0]), r[6]),
    )
    got = sorted(map(tuple, df.collect()), key=lambda r: (repr(r[0]), r[6]))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5:7] == pytest.approx(w[5:7], rel=1e-9)


def test_op4(spark, folder):
    df = QUERIES["op4_token_shards"](spark, folder)
    assert df.columns == ["slot", "shard", "offset", "sequence", "n_tokens", "tokens_sha256", "doc_ids"]
    got = sorted(df.collect(), key=lambda r: r["sequence"])
    assert [r["sequence"] for r in got] == list(range(len(got)))
    assert sorted(r["slot"] for r in got) == list(range(len(got)))
    with open(BYTE_RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    encoder = tiktoken.Encoding("plain", pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {}
    for doc, text, *_ in documents():
        texts.setdefault(doc, set()).add(tuple([*encoder.encode_ordinary(text or ""), TEXT_END]))
    assert all(len(v) == 1 for v in texts.values())
    # The documents in the order in which sequences name them make the stream that sequences cut.
    order = [d for r in got for d in r["doc_ids"]]
    stream: list[int] = []
    ends = np.cumsum([r["n_tokens"] for r in got]).tolist()
    for r, end in zip(got, ends):
        # What the sequence before cut is named first and continues.
        for doc in r["doc_ids"][1 if len(stream) > end - r["n_tokens"] else 0 :]:
            stream += next(iter(texts[doc]))
        cut = stream[end - r["n_tokens"] : end]
        assert r["tokens_sha256"] == sha(np.array(cut, "<u2").tobytes()), r["sequence"]
    assert len(stream) == ends[-1] == sum(len(next(iter(texts[d[0]]))) for d in documents()) and len(order) >= len(documents())


def test_op7(spark, folder, tmp_path):
    df = QUERIES["op7_toxicity"](spark, folder)
    assert df.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    got = df.collect()
    for r in got:
        name = "" if r["doc_id"] is None else str(r["doc_id"])
        assert r["held_out"] == (zlib.crc32(name.encode()) % 4 == 2) and 0 <= r["score"] <= 1
        assert r["predicted"] == (r["score"] >= TOXIC_FROM)
    held = [r for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 240]
    assert len(held) > 30 and all(r["predicted"] == (r["doc_id"] % 5 == 0) for r in held)
    # Labels that are held out teach nothing.
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    wrong = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    wrong.write.parquet(f"{tmp_path}/labels.parquet")
    assert rows_of(QUERIES["op7_toxicity"](spark, str(tmp_path))) == rows_of(df)


def test_op7_learns_what_plain_code_does(spark, folder):
    """Features by the G statistic, and weights where the penalised loss has no slope left but towards negative ones."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet").where(~toxicity.held_out())
    model = toxicity.learn(docs, labels)
    text_of = {d: t for d, t, *_ in documents()}
    taught = [(text_of[r["doc_id"]], r["toxic"]) for r in labels.collect()]
    taught += [(text_of[7], y) for r in labels.collect() if r["doc_id"] == 7 for y in [r["toxic"]] * 2]  # its two other rows
    reader = toxicity.Reader(model)
    p, q, rows = Counter(), Counter(), Counter(y for _, y in taught)
    for text, y in taught:
        (p if y else q).update(toxicity.all_features(set(toxicity.WORDS(reader.restored(text)))))
    n = sum(rows.values())

    def g(f):
        out = 0.0
        for seen, having in ((p[f], rows[1]), (q[f], rows[0])):
            for k, share in ((seen, p[f] + q[f]), (having - seen, n - p[f] - q[f])):
                out += k * log(k * n / (share * having)) if k else 0.0
        return 2 * out

    telling = {f for f in p if p[f] * rows[0] > q[f] * rows[1] and g(f) >= toxicity.TELLING}
    assert set(model.weights) <= telling and telling
    names = list(model.weights)
    x = np.array([[f in reader.features(t) for f in names] + [True] for t, _ in taught], float)
    y, w = np.array([y for _, y in taught], float), np.array([*model.weights.values(), model.intercept])
    slope = x.T @ (1 / (1 + np.exp(-x @ w)) - y) + np.append(np.full(len(names), 0.1), 1e-6) * w
    assert (w[:-1] > 0).all() and abs(slope).max() < 0.05


def test_op4_permutation_is_the_one_of_the_query(spark, folder):
    got = QUERIES["op4_token_shards"](spark, folder).select("slot", "sequence").collect()
    order = Permutation(len(got), 0)
    assert {r["sequence"]: r["slot"] for r in got} == dict(enumerate(order.slots(np.arange(len(got))).tolist()))
