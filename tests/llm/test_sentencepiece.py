"""The merge agenda against the sentencepiece library."""

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from feedworks.llm import sentencepiece_codec as codec

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
TEXTS = [
    "", " ", "  ", "a  b", "▁x", " lead", "trail ", "\n\n", "\t", "😀 é́ 漢字", "<s></s><0x41>", "⁇", "a" * 3000,
    "\x00", "\ufeffx", "’" * 9, " \n \n", "▁▁▁ ▁", "１２", "ab\r\n  cd", "(see) it's n't.\"x\" ... https://a.b/c?d=1",
]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("thion THE ▁\n.,'()"), st.characters(codec="utf-8"))))
def test_ids_and_texts_equal_the_library(text):
    flat, ends = codec.vocabulary(MODEL).encode_batch([text], "parts")
    assert flat.tolist() == LIBRARY.encode(text)
    assert codec.vocabulary(MODEL).decode(flat.tolist()) == LIBRARY.decode(flat.tolist())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 260), st.integers(0, 31999)), max_size=12))
def test_any_ids_decode_as_in_the_library(ids):
    assert codec.vocabulary(MODEL).decode(ids) == LIBRARY.decode(ids)


@pytest.mark.parametrize("check", ["parts", "texts", "none"])
def test_columns(spark, check):
    rows = [(i, t, "kept") for i, t in enumerate([None, *TEXTS, *TEXTS])]
    df = spark.createDataFrame(rows, "doc_id long, text string, decoded string")
    coded = codec.encode_and_decode(df, MODEL, check=check)
    assert coded.columns == ["doc_id", "text", "decoded", "token_ids"]
    for r in coded.collect():
        assert r["token_ids"] == LIBRARY.encode(r["text"] or "")
        assert r["decoded"] == LIBRARY.decode(r["token_ids"])


def test_one_after_the_other(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    both = codec.decode(codec.encode(df, MODEL, check="texts"), MODEL)
    assert all(r["decoded"] == LIBRARY.decode(LIBRARY.encode(r["text"])) for r in both.collect())
    null = codec.decode(spark.createDataFrame([(None,)], "token_ids array<int>"), MODEL)
    assert null.first()["decoded"] == ""


def test_small_memo_changes_nothing(monkeypatch):
    monkeypatch.setattr(codec, "MEMO", 4)
    vocabulary = codec.PieceVocabulary(MODEL)
    flat, ends = vocabulary.encode_batch(TEXTS * 2, "parts")
    assert [flat[a:b].tolist() for a, b in zip(ends, ends[1:])] == LIBRARY.encode(TEXTS * 2)


def test_empty_table(spark):
    df = spark.createDataFrame([], "text string")
    assert codec.encode_and_decode(df, MODEL).count() == 0


def test_a_difference_raises(monkeypatch):
    vocabulary = codec.PieceVocabulary(MODEL)
    vocabulary.ids[" the"] = 5
    with pytest.raises(ValueError, match="differ"):
        vocabulary.encode_batch(["in the end"], "parts")
    with pytest.raises(ValueError, match="unknown check"):
        codec.encode(None, MODEL, check="some")
