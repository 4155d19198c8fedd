"""The pipeline against plain code, stage by stage and as a whole."""

import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline
from feedworks.llm.queries import TOXIC_FROM, toxicity_model
from tests.llm.test_mixing import drawn, shared
from tests.llm.test_ngram_join import plain_join
from tests.llm.test_suffix_tree_lm import WORD

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    draw = random.Random(7)
    place = str(tmp_path_factory.mktemp("corpus"))
    words = [a + b for a in ("ther", "an", "on", "in", "tion") for b in ("ing", "ed", "nd", "at", "ou", "ly", "es")]
    docs, labels = [], []
    for i in range(400):
        toxic = i % 6 == 0
        text = draw.choices(words, k=draw.randint(20, 120))
        if toxic:
            for _ in range(3):
                text.insert(draw.randrange(len(text)), draw.choice(["scum", "idiot", "moron"]))
        if i % 4 < 3:
            labels.append((i, 1, int(toxic)))
        docs.append((i, " ".join(text), "en", draw.choice(["a", "b", "c", None]), 1))
    for i in range(400, 480):  # exact and near copies
        other = docs[draw.randrange(400)]
        text = other[1].split(" ")
        if i % 4 < 3:
            text[draw.randrange(len(text))] = "changed"
        docs.append((i, " ".join(text), "en", "a", 1))
    docs += [(480, None, None, None, None), (481, "", "en", "b", 0)]
    docs.append((482, "i d i o t  that 1s " + "at ou ly " * 30, "en", "b", 9))
    spark.createDataFrame(docs, SCHEMA).write.parquet(f"{place}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{place}/labels.parquet")
    return place


def test_equals_plain_code(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    model = toxicity_model(spark, docs, folder)
    scores = dict(zip(rows, model.score_all([r["text"] or "" for r in rows.values()])))
    clean = [d for d in rows if scores[d] < TOXIC_FROM]
    assert 300 < len(clean) < 450 and 482 not in clean
    groups = plain_join([(d, rows[d]["text"]) for d in clean])
    single = [d for d in clean if groups[d][0] == d]
    assert len(single) < len(clean)
    size = {d: len(WORD.findall(rows[d]["text"] or "")) for d in single}
    sources = Counter()
    for d in single:
        sources[rows[d]["source"]] += size[d]
    target = shared(dict(sources))
    want = Counter()
    for d in single:
        total = sources[rows[d]["source"]]
        rate = target[rows[d]["source"]] / total if total else 0
        copies = int(rate) + (drawn(tuple(rows[d])) < rate - int(rate))
        if copies:
            want[d] = copies
    got = corpus_pipeline.run(spark, folder).collect()
    assert Counter(r["doc_id"] for r in got) == want
    for r in got:
        text = rows[r["doc_id"]]["text"] or ""
        assert r["token_ids"] == LIBRARY.encode(text) and r["decoded"] == LIBRARY.decode(r["token_ids"])
        assert tuple(r)[:5] == tuple(rows[r["doc_id"]])


def test_stages_keep_the_columns_of_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_join", "mixing", "sentencepiece"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).dtypes == docs.dtypes
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).columns[:5] == docs.columns


def test_an_empty_table_goes_through(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0
