"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

A text is normalised as its model says (a space in front, U+2581 for a space) and cut into
parts where no piece of the vocabulary holds the two characters side by side. Within
a part an agenda holds the adjacent symbol pairs that form a piece, best score first,
leftmost on ties; the best pair is merged, its new neighbours enter the agenda, and
entries whose symbols have changed since are passed over. What ends up outside the
vocabulary becomes its UTF-8 bytes. Merges of one part never depend on another, so
their result can be kept: a task keeps what it met, up to ``MEMO`` entries.

In each Arrow batch every part that the task has not met yet is also encoded
by the sentencepiece library, all in one call, and compared. ``check="texts"``
compares the whole texts instead. A difference raises, as it would mean wrong ids.

Null and empty texts have no ids, no ids decode to an empty text. Rows are taken one by one,
so ties and repeated rows mean nothing here. An existing column with the name of an
output is replaced; all others pass through.
"""

from __future__ import annotations

import codecs
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType
from sentencepiece import sentencepiece_model_pb2

from feedworks.llm.common import free_name, slices

SPACE = "▁"
#: Parts whose ids a task keeps, half of them from the last round and half from the one
#: before; then the older half goes. Bounds memory, not results.
MEMO = 300_000

codecs.register_error("each_byte", lambda e: ("�", e.start + 1))


class Memo(dict):
    """Results by argument; ``fresh`` lists the arguments worked out since it was last emptied."""

    def __init__(self, work):
        super().__init__()
        self.work, self.fresh, self.older = work, [], {}

    def __missing__(self, key: str) -> bytes:
        found = self.older.get(key)
        if found is None:
            found = self.work(key)
            self.fresh.append(key)
        self[key] = found
        return found

    def shrink(self, most: int) -> None:
        if len(self) > most // 2:
            self.older = dict(self)
            self.clear()


class PieceVocabulary:
    """A merge-type model: pieces with their scores, and the library for comparison."""

    def __init__(self, model_file: str):
        with open(model_file, "rb") as f:
            raw = f.read()
        model = sentencepiece_model_pb2.ModelProto()
        model.ParseFromString(raw)
        kinds = {name: number for name, number in model.SentencePiece.Type.items()}
        spec, trainer = model.normalizer_spec, model.trainer_spec
        normal = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kinds["NORMAL"]}
        bytes_ = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kinds["BYTE"]}
        spans = any(SPACE in p.lstrip(SPACE) for p in normal)
        if (
            trainer.model_type != trainer.BPE
            or len(bytes_) != 256
            or spec.precompiled_charsmap
            or spec.remove_extra_whitespaces
            or not (spec.add_dummy_prefix and spec.escape_whitespaces)
            or trainer.treat_whitespace_as_suffix
            or any(p.type in (kinds["USER_DEFINED"], kinds["UNUSED"]) for p in model.pieces)
            or spans
        ):
            raise ValueError("only plain BPE models with byte fallback and identity normalisation are supported")
        # Texts are worked on with plain spaces, of which pieces have none otherwise.
        self.ids = {p.replace(SPACE, " "): i for p, i in normal.items()}
        # Pieces of one score share a rank: of their pairs the leftmost is merged first.
        order = {score: k for k, score in enumerate(sorted({model.pieces[i].score for i in normal.values()}, reverse=True))}
        self.ranks = {p: order[model.pieces[i].score] for p, i in self.ids.items() if len(p) > 1}
        self.pairs = {p[i : i + 2] for p in self.ranks for i in range(len(p) - 1)}
        self.byte_ids = [bytes_[f"<0x{b:02X}>"] for b in range(256)]
        self.library = sentencepiece.SentencePieceProcessor(model_proto=raw)
        # Letters and what may follow a letter within a piece are one kind of character, the
        # others another: no merge crosses from the first kind to the second. A character that
        # no longer piece contains is always a part of its own.
        joining = {c for p in self.ranks for c in p} - {" "}
        wordly = {c for c in joining if c.isalpha()}
        while more := {p[1] for p in self.pairs if p[0] in wordly and p[1] in joining - wordly}:
            wordly |= more
        inner, other = ("".join(map(re.escape, sorted(x))) for x in (wordly, joining - wordly))
        self.parts_of = re.compile(f" *[{inner}]+| *[{other}]+[{inner}]*| +|[^{inner}{other} ]").findall
        # Byte pieces stand for raw bytes until the whole text is put together.
        self.texts = ["" if p.type != kinds["UNKNOWN"] else " ⁇ " for p in model.pieces]
        for p, i in normal.items():
            self.texts[i] = p.replace(SPACE, " ")
        for b, i in enumerate(self.byte_ids):
            self.texts[i] = chr(b) if b < 128 else chr(0xDC00 + b)
        self.leading = {i for p, i in normal.items() if p.startswith(SPACE)}
        self.control = {i for i, p in enumerate(model.pieces) if p.type == kinds["CONTROL"]}
        self.memo = Memo(self.merge)

    def merge(self, part: str) -> bytes:
        """The ids of one part as 32-bit integers, by its agenda."""
        rank_of, n = self.ranks.get, len(part)
        symbols = list(part)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = [r << 32 | i for i in range(n - 1) if (r := rank_of(part[i : i + 2])) is not None]
        heapq.heapify(agenda)
        while agenda:
            entry = heapq.heappop(agenda)
            left = entry & 0xFFFFFFFF
            right = after[left]
            if right == n or not symbols[left]:
                continue
            merged = symbols[left] + symbols[right]
            if rank_of(merged) != entry >> 32:
                continue  # one of the two has changed since
            symbols[left], symbols[right] = merged, ""
            after[left] = following = after[right]
            if following < n:
                before[following] = left
                if (r := rank_of(merged + symbols[following])) is not None:
                    heapq.heappush(agenda, r << 32 | left)
            previous = before[left]
            if previous >= 0 and (r := rank_of(symbols[previous] + merged)) is not None:
                heapq.heappush(agenda, r << 32 | previous)
        ids: list[int] = []
        for symbol in symbols:
            if symbol:
                known = self.ids.get(symbol)
                ids.extend([known] if known is not None else map(self.byte_ids.__getitem__, symbol.encode()))
        return np.array(ids, np.int32).tobytes()

    def encode_batch(self, texts: list[str], check: str = "none") -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and where each text's begin."""
        ids, ends = [], [0]
        for text in texts:
            if text:
                parts = self.parts_of(" " + text.replace(SPACE, " "))
                ids.append(b"".join(map(self.memo.__getitem__, parts)))
            ends.append(ends[-1] + (len(ids[-1]) // 4 if text else 0))
            if len(self.memo) > MEMO // 2:
                self.compare(check)
                self.memo.shrink(MEMO)
        flat = np.frombuffer(b"".join(ids), np.int32)
        self.compare(check)
        if check == "texts":
            for text, found, start, end in zip(texts, self.library.encode(texts, num_threads=1), ends, ends[1:]):
                if found != flat[start:end].tolist():
                    raise ValueError(f"the agenda's ids of {text[:100]!r} differ from the library's")
        return flat, np.array(ends, np.int32)

    def compare(self, check: str) -> None:
        """New parts against the library, which puts a space in front of whatever it encodes."""
        parts, self.memo.fresh = self.memo.fresh, []
        if check != "parts":
            return
        # A line break is in no longer piece, so what follows it is merged on its own.
        lead = self.library.encode("\n", num_threads=1)
        for part, found in zip(parts, self.library.encode(["\n" + p for p in parts], num_threads=1)):
            if found != lead + np.frombuffer(self.memo[part], np.int32).tolist():
                raise ValueError(f"the agenda's ids of {part!r} differ from the library's")

    def decode(self, ids: list[int]) -> str:
        shown = ids if self.control.isdisjoint(ids) else [i for i in ids if i not in self.control]
        if len(shown) < len(ids):  # bytes on both sides of a control id are no one character
            runs, start = [], 0
            for end in [k for k, i in enumerate(ids) if i in self.control] + [len(ids)]:
                runs.append(self.plain(ids[start:end]))
                start = end + 1
            text = "".join(runs)
        else:
            text = self.plain(ids)
        # The space that encoding put in front of the text goes.
        return text[1:] if shown and shown[0] in self.leading else text

    def plain(self, ids: list[int]) -> str:
        text = "".join(map(self.texts.__getitem__, ids))
        return text if text.isascii() else text.encode("utf-8", "surrogateescape").decode("utf-8", "each_byte")


@lru_cache(maxsize=2)
def vocabulary(model_file: str) -> PieceVocabulary:
    return PieceVocabulary(model_file)


def _encoded(batch: pa.Array, model_file: str, check: str):
    """Ids of the batch's texts, some texts at a time: a list array for each slice."""
    for part in slices(batch):
        flat, ends = vocabulary(model_file).encode_batch(part.to_pylist(), check)
        yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))


def _decoded(ids: pa.Array, model_file: str) -> pa.Array:
    pieces = vocabulary(model_file)
    ends, flat = ids.offsets.to_numpy(), ids.values.to_numpy(zero_copy_only=False)
    return pa.array([pieces.decode(flat[a:b].tolist()) for a, b in zip(ends, ends[1:])], pa.string())


def _known(check: str) -> str:
    if check not in ("parts", "texts", "none"):
        raise ValueError(f"unknown check: {check}")
    return check


def encode(
    df: DataFrame, model_file: str, text: str = "text", out: str = "token_ids", check: str = "parts"
) -> DataFrame:
    """``df`` with the ids of ``text`` (array of int, without begin and end) as ``out``.

    ``model_file`` is a path on every executor; ``check`` is parts, texts or none.
    """
    _known(check)

    @F.arrow_udf(ArrayType(IntegerType()))
    def ids_of(batch: pa.Array) -> pa.Array:
        none = pa.array([], pa.list_(pa.int32()))
        return pa.concat_arrays([none, *_encoded(batch, model_file, check)])

    return df.withColumn(out, ids_of(F.coalesce(F.col(text), F.lit(""))))


def decode(df: DataFrame, model_file: str, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """``df`` with the text that ``ids`` stand for as ``out``; null ids give an empty text."""

    @F.arrow_udf(StringType())
    def text_of(batch: pa.Array) -> pa.Array:
        return _decoded(batch, model_file)

    return df.withColumn(out, text_of(F.coalesce(F.col(ids), F.array().cast("array<int>"))))


def encode_and_decode(
    df: DataFrame,
    model_file: str,
    text: str = "text",
    ids_out: str = "token_ids",
    text_out: str = "decoded",
    check: str = "parts",
) -> DataFrame:
    """Both in one pass: the ids of ``text``, and the text that those ids stand for.

    Rows go through in small parts, so neither side holds more than a part's ids at a time.
    """
    _known(check)
    ids_at, text_at = free_name(df, "coded_ids"), free_name(df, "coded_text")
    schema = StructType(list(df.schema.fields)).add(ids_at, ArrayType(IntegerType())).add(text_at, StringType())
    source = next(c for c in df.columns if c.lower() == text.lower())

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (part for batch in batches for part in slices(batch)):
            texts = [t or "" for t in part.column(source).to_pylist()]
            flat, ends = vocabulary(model_file).encode_batch(texts, check)
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
            yield pa.record_batch([*part.columns, ids, _decoded(ids, model_file)], schema.names)

    coded = df.mapInArrow(both, schema)
    return coded.withColumns({ids_out: F.col(ids_at), text_out: F.col(text_at)}).drop(ids_at, text_at)
