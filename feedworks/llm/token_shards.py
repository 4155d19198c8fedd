"""Token ids in training order, as fixed-stride binary shards.

Documents are encoded, ended by ``end_id`` and packed one after the other into sequences of
``length`` tokens (16-bit numbers, little-endian). A keyed Feistel network permutes the numbers of all
sequences: it works on the next power of four, and is walked on until it lands inside. So
every sequence gets its own slot of the training order, without a sort of the corpus by
random keys, and the slot of any sequence, or the sequence of any slot, can be worked out.

Slots go to shards by ranges, ``records`` to a shard. A shard is one file of equal records,

    sequence number (8 bytes) | tokens in use (4 bytes) | tokens, zeros after them

so record ``i`` of shard ``s`` is slot ``s * records + i``, at byte ``i * stride``: reading on from a
slot is one seek. A line break ends the file. Spark writes the files, so they reach
any store that it writes to, and a lost executor leaves no half of one.

Sequences are numbered by the partitions in which ``df`` is read, so the same order of training needs the
same key and the same partitions: other files or another ``spark.sql.files.maxPartitionBytes`` give another
order, as another key does. What was written keeps its own.

Null and empty texts are one end token, and a text of any length runs over as many sequences as it needs. Rows
count one by one, repeated ones included; ids may
be null. The last sequence of each input partition may be part empty. An empty table writes
no shard. Other columns are not used.
"""

from __future__ import annotations

import base64
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedworks.llm.common import fresh_path, slices, text_or_empty, written
from feedworks.llm.hashing import mixed

ROUNDS = 4
#: Sequences that are compressed together.
GROUP = 64
GROUPS = "part int, number long, doc_ids array<array<long>>, used array<int>, tokens binary"
DEALT = "shard long, slots array<long>, sequences array<long>, used array<int>, tokens binary"
HEADER = np.dtype([("sequence", "<i8"), ("used", "<u4")])


class Permutation:
    """A keyed one-to-one map of 0 .. n-1 onto itself."""

    def __init__(self, n: int, key: int):
        self.n = n
        self.half = np.uint64(max(1, -(-max(1, (n - 1).bit_length()) // 2)))
        self.mask = np.uint64((1 << int(self.half)) - 1)
        self.keys = mixed(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key))

    def _walk(self, x: np.ndarray, once: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        x = once(np.asarray(x).astype(np.uint64))
        while len(out := np.flatnonzero(x >= np.uint64(self.n))):
            x[out] = once(x[out])
        return x.astype(np.int64)

    def _forward(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for key in self.keys:
            left, right = right, left ^ (mixed(right + key) & self.mask)
        return (left << self.half) | right

    def _backward(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for key in self.keys[::-1]:
            left, right = right ^ (mixed(left + key) & self.mask), left
        return (left << self.half) | right

    def slots(self, sequences: np.ndarray) -> np.ndarray:
        return self._walk(sequences, self._forward)

    def sequences(self, slots: np.ndarray) -> np.ndarray:
        return self._walk(slots, self._backward)


@lru_cache(maxsize=1)
def encoding(ranks_file: str, pattern: str) -> tiktoken.Encoding:
    with open(ranks_file, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("shards", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@dataclass(frozen=True)
class Shards:
    """Where shards are, and how they are laid out."""

    path: str
    sequences: int
    length: int
    records: int
    key: int

    @property
    def stride(self) -> int:
        return HEADER.itemsize + 2 * self.length

    def read(self, spark: SparkSession, first: int = 0, last: int | None = None) -> DataFrame:
        """The records of the slots from ``first`` to before ``last``, from the shards that hold them."""
        last = self.sequences if last is None else min(last, self.sequences)
        schema = "slot long, shard long, offset long, sequence long, n_tokens int, tokens binary"
        if first >= last:
            return spark.createDataFrame([], schema)
        files = spark.read.format("binaryFile").load(self.path)
        wanted = files.where(F.col("shard").between(first // self.records, (last - 1) // self.records))
        stride, records = self.stride, self.records

        def cut(batches):
            for batch in batches:
                for shard, content in zip(batch.column("shard").to_pylist(), batch.column("content")):
                    data = np.frombuffer(content.as_py(), np.uint8)
                    rows = data[: len(data) // stride * stride].reshape(-1, stride)
                    head = np.ascontiguousarray(rows[:, : HEADER.itemsize]).view(HEADER).ravel()
                    slots = shard * records + np.arange(len(rows))
                    at = np.flatnonzero((slots >= first) & (slots < last))
                    used = head["used"][at].astype(np.int32)
                    tokens = [rows[i, HEADER.itemsize : HEADER.itemsize + 2 * n].tobytes() for i, n in zip(at, used)]
                    columns = [slots[at], np.full(len(at), shard), at * stride, head["sequence"][at], used]
                    yield pa.record_batch(
                        [*map(pa.array, columns), pa.array(tokens, pa.binary())],
                        ["slot", "shard", "offset", "sequence", "n_tokens", "tokens"],
                    )

        return wanted.select(F.col("shard").cast("long"), "content").mapInArrow(cut, schema)


def write_shards(
    df: DataFrame,
    ranks_file: str,
    pattern: str,
    end_id: int,
    path: str | None = None,
    length: int = 2048,
    records: int = 2048,
    key: int = 0,
    doc_id: str = "doc_id",
    text: str = "text",
) -> tuple[Shards, DataFrame]:
    """Write the texts of ``df`` as shards below ``path`` (by default a fresh shared folder).

    Returns the layout, and a table that has for each sequence the ids of its documents.
    """
    spark = df.sparkSession
    path = path or fresh_path(spark, "shards")

    def sequences(batches):
        part = TaskContext.get().partitionId()
        number, held, size, docs = 0, [], 0, []

        def take(n):
            # The first n tokens that are held, and the documents that they are from.
            nonlocal held, size, docs
            stream = np.concatenate(held) if len(held) > 1 else held[0]
            ids = [doc for doc, begin in docs if begin < n]
            last = docs[len(ids) - 1 :]
            # The document that the cut goes through has the rest of its tokens ahead.
            ends = last[1][1] if len(last) > 1 else len(stream)
            rest = ([(last[0][0], 0)] if ends > n else []) + [(d, b - n) for d, b in last[1:]]
            held, size, docs = [stream[n:]], size - n, rest
            return ids, stream[:n]

        def group(least):
            # Whole sequences, and at the end the rest: compressed together.
            nonlocal number
            rows = []
            while size >= least and len(rows) < GROUP:
                rows.append(take(min(size, length)))
            number += len(rows)
            return group_batch(part, number - len(rows), rows)

        for rows in (rows for batch in batches for rows in slices(batch)):
            for doc, words in zip(rows.column("doc_id").to_pylist(), rows.column("text").to_pylist()):
                tokens = encoding(ranks_file, pattern).encode_ordinary(words)
                docs.append((doc, size))
                held.append(np.array([*tokens, end_id], "<u2"))
                size += len(tokens) + 1
                while size >= GROUP * length:
                    yield group(length)
        while size:
            yield group(1)

    encoded = df.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    packed = written(encoded.mapInArrow(sequences, GROUPS), "sequences")
    # One count for each input partition.
    counts = {r["part"]: r["n"] for r in packed.groupBy("part").agg(F.sum(F.size("used")).alias("n")).collect()}
    starts, total = {}, 0
    for part in sorted(counts):
        starts[part] = total
        total += counts[part]
    layout = Shards(path, total, length, records, key)
    order = Permutation(max(total, 1), key)
    # Broadcast: two numbers for each input partition.
    begins = spark.createDataFrame(list(starts.items()), "part int, begin long")
    numbered = packed.join(F.broadcast(begins), "part").withColumn("first", F.col("begin") + F.col("number"))
    sources = numbered.select("first", F.posexplode("doc_ids").alias("at", "doc_ids")).select(
        (F.col("first") + F.col("at")).alias("sequence"), "doc_ids"
    )
    if not total:
        return layout, sources

    def deal(batches):
        # Sequences that go to one shard travel together, as far as a task has them at hand.
        waiting: dict[int, list[tuple[int, int, bytes]]] = {}
        held = 0
        for rows in (rows for batch in batches for rows in slices(batch, 16)):
            for first, used, tokens in zip(*(rows.column(c).to_pylist() for c in ("first", "used", "tokens"))):
                stream = pa.decompress(tokens, 2 * sum(used), "zstd", asbytes=True)
                numbers = first + np.arange(len(used))
                at = 0
                for sequence, slot, n in zip(numbers.tolist(), order.slots(numbers).tolist(), used):
                    own = waiting.setdefault(slot // records, [])
                    own.append((slot, sequence, stream[at : at + 2 * n]))
                    at += 2 * n
                    held += 1
                    if len(own) == GROUP:
                        held -= GROUP
                        yield dealt_batch({slot // records: waiting.pop(slot // records)})
            if held >= 64 * GROUP:
                yield dealt_batch(waiting)
                waiting, held = {}, 0
        if waiting:
            yield dealt_batch(waiting)

    dealt = numbered.select("first", "used", "tokens").mapInArrow(deal, DEALT)
    stride = layout.stride

    def fill(batches):
        # Rows come shard by shard: a shard is whole once the next one begins.
        shard, content = None, bytearray()
        for rows in (rows for batch in batches for rows in slices(batch, 16)):
            columns = (rows.column(c).to_pylist() for c in ("shard", "slots", "sequences", "used", "tokens"))
            for own, slots, numbers, used, tokens in zip(*columns):
                if own != shard:
                    if shard is not None:
                        yield shard_batch(shard, content)
                    shard, content = own, bytearray(stride * min(records, total - own * records))
                stream = pa.decompress(tokens, 2 * sum(used), "zstd", asbytes=True)
                at = 0
                for slot, number, n in zip(slots, numbers, used):
                    begin = (slot - own * records) * stride
                    record = np.array([(number, n)], HEADER).tobytes() + stream[at : at + 2 * n]
                    content[begin : begin + len(record)] = record
                    at += 2 * n
        if shard is not None:
            yield shard_batch(shard, content)

    ordered = dealt.repartitionByRange("shard").sortWithinPartitions("shard")
    shards = ordered.mapInArrow(fill, "shard long, content binary")
    # Binary as string: the text writer puts out the bytes as they are.
    shards.select("shard", F.col("content").cast("string").alias("value")).write.partitionBy("shard").text(path)
    return layout, sources


def together(parts: list[bytes]) -> bytes:
    return pa.Codec("zstd", 3).compress(b"".join(parts), asbytes=True)


def group_batch(part: int, number: int, rows: list[tuple[list, np.ndarray]]) -> pa.RecordBatch:
    return pa.record_batch(
        [
            pa.array([part], pa.int32()),
            pa.array([number], pa.int64()),
            pa.array([[ids for ids, _ in rows]], pa.list_(pa.list_(pa.int64()))),
            pa.array([[len(tokens) for _, tokens in rows]], pa.list_(pa.int32())),
            pa.array([together([tokens.tobytes() for _, tokens in rows])], pa.binary()),
        ],
        ["part", "number", "doc_ids", "used", "tokens"],
    )


def dealt_batch(waiting: dict[int, list[tuple[int, int, bytes]]]) -> pa.RecordBatch:
    rows = list(waiting.values())
    return pa.record_batch(
        [
            pa.array(list(waiting), pa.int64()),
            pa.array([[slot for slot, _, _ in row] for row in rows], pa.list_(pa.int64())),
            pa.array([[number for _, number, _ in row] for row in rows], pa.list_(pa.int64())),
            pa.array([[len(tokens) // 2 for _, _, tokens in row] for row in rows], pa.list_(pa.int32())),
            pa.array([together([tokens for _, _, tokens in row]) for row in rows], pa.binary()),
        ],
        ["shard", "slots", "sequences", "used", "tokens"],
    )


def shard_batch(shard: int, content: bytearray) -> pa.RecordBatch:
    return pa.record_batch([pa.array([shard], pa.int64()), pa.array([bytes(content)], pa.binary())], ["shard", "content"])

