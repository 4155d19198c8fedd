"""Language-model scores by a probabilistic suffix tree over words.

A state is a context of one to ``DEPTH`` words. It is retained if it was seen often enough and
its next-word distribution diverges from that of its suffix (the context without its first
word): the log-likelihood gain of its own counts, each occurrence left out of them in turn,
must exceed ``GAIN``. A longer context is tried only where its suffix is a state and its own first
words were tried, whose counts tell how often it occurs: (a, b, c) is passed over where (b) is no state,
even if (b, c) is one. In the gain, the suffix's probability of a word counts in steps of an eighth of a
bit, up to 31.9 bits, which is how buckets are told of it; scores use exact probabilities. Distributions are smoothed by absolute discounting, the discounted mass
going to the suffix state; at the root words have (c + 0.1) / (N + 0.1 (V + 1)). A text is scored
by the longest retained suffix of the words before each word. Probabilities of all next
words add up to one in every state.

Tokens are the words of the lower-cased (A-Z) text and one end per text. Words and contexts
are known by 64-bit hashes, next words within a context by 32 bits. Counts within a chunk have 32
bits, those of the corpus 64.

How it runs: texts become chunks of about ``CHUNK`` tokens, one written row each, with a
vocabulary of their own. For words, then for contexts of one word, two words and so on,
every chunk sends what it has seen, sorted and packed, to the buckets that its contexts hash to;
a bucket adds up and answers each chunk with the counts of what that chunk sent.
Chunks and answers are written tables, so a lost executor costs a step, not the
job. A context with more than a bucket's share of the corpus is split by its next words, and
its parts are added up on the driver: there are at most ``2 * SPLIT_CONTEXTS`` of those.

Null and empty texts are one end token; a text of any length is part of one chunk. A null id is held out. Rows are scored one
by one, whatever ids they repeat; copies count as often as they occur. An empty table
gives an empty table. Only the id and text columns of the input are used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedworks.llm.common import give_back, text_or_empty, written
from feedworks.llm.hashing import U, mixed, word_hashes

DEPTH = 3
#: A context needs this many occurrences, and this gain in nats, to become a state.
LEAST, GAIN = 8, 4.0
DISCOUNT = 0.75
#: Tokens of a chunk, entries of a bucket: what a task holds at a time.
CHUNK, BUCKET = 1 << 20, 1 << 20
#: Contexts are split so that at most this many can need it, whatever the corpus.
SPLIT_CONTEXTS = 200_000
#: Chunks and messages that a Python worker is given at a time.
ROWS = 1
END, SALT = U(0x5851F42D4C957F2D), U(0xD1B54A32D192ED03)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

CHUNKS = "chunk long, ids array<long>, held array<boolean>, lengths binary, words binary, tokens binary, size long"
MESSAGES = (
    "bucket int, chunk long, entries binary, counts binary, lone binary, split binary, "
    "next binary, seen binary, parent binary"
)
#: With the last messages a chunk sends, as bucket -1, what is left to do for it.
LAST_MESSAGES = f"{MESSAGES}, ids array<long>, held array<boolean>, sums binary"
ANSWERS = "chunk long, depth int, bucket int, counts binary, states binary"


def pack(values: np.ndarray) -> bytes:
    """Numbers as bytes, the first bytes of all of them first, compressed."""
    if not len(values):
        return bytes(8)
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T
    raw = np.ascontiguousarray(planes).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def unpack(data: bytes, kind: type) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    if not size:
        return np.empty(0, kind)
    raw = np.frombuffer(pa.decompress(data[8:], size, "zstd", asbytes=True), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(kind).ravel()


def held_out(doc_id: str | Column = "doc_id", of: int = 10, remainder: int = 0) -> Column:
    name = F.coalesce((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string"), F.lit(""))
    return F.crc32(name.cast("binary")) % of == remainder


def to_chunks(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text, held_out) as chunks of tokens."""
    most = CHUNK

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Numbered within the partition; written at once, so a number never changes.
        number = TaskContext.get().partitionId() << 32
        ids, held, tokens, size = [], [], [], 0
        for batch in batches:
            columns = zip(batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist())
            for (doc, out), text in zip(columns, batch.column("text").cast(pa.binary())):
                words = word_hashes(LOWER[np.frombuffer(text.as_py(), np.uint8)])
                ids.append(doc)
                held.append(out)
                tokens.append(np.append(words, END))
                size += len(words) + 1
                if size >= most:
                    yield chunk_row(number, ids, held, tokens)
                    number += 1
                    ids, held, tokens, size = [], [], [], 0
        if ids:
            yield chunk_row(number, ids, held, tokens)

    return docs.mapInArrow(chunks, CHUNKS)


def chunk_row(number: int, ids: list, held: list, tokens: list[np.ndarray]) -> pa.RecordBatch:
    words, local = np.unique(np.concatenate(tokens), return_inverse=True)
    lengths = np.array([len(t) for t in tokens], np.uint32)
    columns = [
        pa.array([number], pa.int64()),
        pa.array([ids], pa.list_(pa.int64())),
        pa.array([held], pa.list_(pa.bool_())),
        *(pa.array([pack(x)], pa.binary()) for x in (lengths, words, local.astype(np.uint32))),
        pa.array([len(words)], pa.int64()),
    ]
    return pa.record_batch(columns, ["chunk", "ids", "held", "lengths", "words", "tokens", "size"])


def buckets_of(sorted_hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's part of sorted hashes begins: buckets are ranges of hashes."""
    edges = np.array([(b << 64) // buckets for b in range(buckets)], object).astype(U)
    return np.append(np.searchsorted(sorted_hashes, edges), len(sorted_hashes))


def in_order(entry: np.ndarray, following: np.ndarray) -> np.ndarray:
    """The order by entry number, then next word."""
    return np.argsort(entry.astype(U) << U(32) | following)


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """One row at a time: a row is a whole chunk, of which a batch may hold many."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]
            give_back()


class Corpus:
    """What all tasks know: totals, and the states of contexts that are split over buckets."""

    def __init__(self, buckets: int, tokens: int = 0, words: int = 0):
        self.buckets, self.tokens, self.words = buckets, tokens, words
        self.hot = max(1 << 16, tokens // SPLIT_CONTEXTS)
        self.split: dict[int, tuple[np.ndarray, np.ndarray]] = {}


class Chunk:
    """A chunk at work: its tokens, and what is known of their contexts so far."""

    def __init__(self, row: dict):
        self.ids, self.number = row["ids"], row["chunk"]
        self.lengths = unpack(row["lengths"], np.uint32).astype(np.int64)
        self.words = unpack(row["words"], U)
        self.tokens = unpack(row["tokens"], np.uint32)
        self.held = np.array(row["held"], bool)
        self.doc = np.repeat(np.arange(len(self.lengths), dtype=np.int32), self.lengths)
        self.train = ~self.held[self.doc]
        ends = np.cumsum(self.lengths)
        self.place = (np.arange(len(self.tokens)) - (ends - self.lengths)[self.doc]).astype(np.int32)

    def word_counts(self) -> np.ndarray:
        return np.bincount(self.tokens[self.train], minlength=len(self.words)).astype(np.uint32)

    def start(self, corpus: Corpus, counts: np.ndarray) -> None:
        """Take the counts of the chunk's words; all positions are in the root state."""
        # All that depends on the word alone is worked out once for each different word.
        self.word_seen = counts.astype(np.int64)
        self.seen = self.word_seen[self.tokens]
        self.p = ((self.word_seen + 0.1) / (corpus.tokens + 0.1 * (corpus.words + 1)))[self.tokens]
        self.next = (mixed(self.words + U(0x2545F4914F6CDD1D)) >> U(32)).astype(np.uint32)[self.tokens]
        self.context = np.zeros(len(self.tokens), U)
        # Whether the context before a word is a state.
        self.state = np.ones(len(self.tokens), bool)

    def after_one_word(self, corpus: Corpus) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions whose context is one word: their entries' numbers, and all entries."""
        at = np.flatnonzero(self.place >= 1)
        before = self.tokens[at - 1]
        often = (self.word_seen >= LEAST)[before]
        at, before = at[often], before[often]
        contexts = mixed(self.words + U(1))
        self.context[at] = contexts[before]
        parts = np.maximum(-(-self.word_seen // corpus.hot), 1)
        begin = np.cumsum(parts) - parts
        of = np.repeat(np.arange(len(parts)), parts)
        salt = np.arange(len(of)) - begin[of]
        entries = mixed(contexts[of] + salt.astype(U) * SALT)
        order = np.argsort(entries)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        number = begin[before]
        split = np.flatnonzero(parts[before] > 1)
        number[split] += self.next[at[split]] % parts[before[split]]
        number = rank[number]
        used = np.bincount(number, minlength=len(order)) > 0
        self.split = np.where(parts[of] > 1, contexts[of], U(0))[order][used]
        return at, (np.cumsum(used) - 1)[number], entries[order][used]

    def after_more_words(self, depth: int, corpus: Corpus) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same for contexts of more words."""
        at = np.flatnonzero((self.place >= depth) & self.state)
        # The context ends with the word before: it is the key that was counted there.
        at = at[self.key_count[at - 1] >= LEAST]
        often = self.key_count[at - 1]
        self.context[at] = mixed(self.context[at] * U(0x9FB21C651E98DF25) + self.words[self.tokens[at - depth]] + U(depth))
        parts = np.maximum(-(-often // corpus.hot), 1)
        salt = self.next[at] % parts
        entries, first, number = np.unique(
            mixed(self.context[at] + salt.astype(U) * SALT), return_index=True, return_inverse=True
        )
        self.split = np.where(parts[first] > 1, self.context[at[first]], U(0))
        return at, number, entries

    def extend(self, depth: int, corpus: Corpus) -> None:
        """Go on to contexts that are one word longer, where their suffix is a state."""
        at, number, self.entries = self.after_one_word(corpus) if depth == 1 else self.after_more_words(depth, corpus)
        order = in_order(number, self.next[at])
        self.at, self.entry_of = at, number = at[order], number[order]
        # Words seen once in the corpus are left to the suffix state: they are only counted.
        train, rare = self.train[at], self.seen[at] < 2
        self.lone = np.bincount(self.entry_of[rare & train & (self.seen[at] == 1)], minlength=len(self.entries)).astype(np.uint32)
        known = np.flatnonzero(~rare)
        e, x = self.entry_of[known], self.next[at[known]]
        new = np.append(True, (e[1:] != e[:-1]) | (x[1:] != x[:-1]))[: len(known)]
        key = np.cumsum(new) - 1
        self.key_of = np.full(len(at), -1)
        self.key_of[known] = key
        start = np.flatnonzero(new)
        self.key_next = x[start]
        self.key_entry = e[start]
        self.key_seen = np.bincount(key, weights=train[known], minlength=len(start)).astype(np.uint32)
        parent = self.p[at[known][start]]
        self.key_parent = np.clip(np.rint(-8 * np.log2(parent)), 0, 255).astype(np.uint8)

    def messages(self, corpus: Corpus) -> Iterator[list]:
        edges = buckets_of(self.entries, corpus.buckets)
        keys = np.searchsorted(self.key_entry, edges)
        per_entry = np.bincount(self.key_entry, minlength=len(self.entries)).astype(np.uint32)
        for b in np.flatnonzero(np.diff(edges)):
            e, k = slice(edges[b], edges[b + 1]), slice(keys[b], keys[b + 1])
            own = [self.entries[e], per_entry[e], self.lone[e], self.split[e]]
            yield [int(b), self.number, *map(pack, (*own, self.key_next[k], self.key_seen[k], self.key_parent[k]))]

    def learn(self, depth: int, corpus: Corpus, answers: dict[int, tuple[bytes, bytes]]) -> None:
        """Take the buckets' answers: probabilities move on to the states that were found."""
        n, is_state, p = settle(depth, corpus, answers, self.split, self.entry_of, self.key_of, self.p[self.at])
        self.p[self.at] = p
        self.state = np.zeros(len(self.tokens), bool)
        self.state[self.at[is_state]] = True
        self.key_count = np.zeros(len(self.tokens), np.int64)
        self.key_count[self.at] = n

    def carried(self, corpus: Corpus) -> list:
        """All that the last answers are still needed for: sums by text, and the words they may change."""
        docs, done = len(self.ids), np.log10(self.p)
        base = np.log10(self.seen + 0.1) - np.log10(corpus.tokens + 0.1 * (corpus.words + 1))
        done[self.at] = 0
        sums = [self.lengths, np.bincount(self.doc[self.seen > 0], minlength=docs)]
        sums += [np.bincount(self.doc, x, docs) for x in (base, done)]
        return [
            -1, self.number, b"", pack(np.bincount(self.entry_of, minlength=len(self.entries)).astype(np.uint32)),
            b"", pack(self.split), pack(self.key_of.astype(np.int32)), pack(self.doc[self.at].astype(np.uint32)),
            pack(self.p[self.at]), self.ids, self.held.tolist(), pack(np.stack(sums).astype(float).ravel()),
        ]


def settle(
    depth: int,
    corpus: Corpus,
    answers: dict[int, tuple[bytes, bytes]],
    split: np.ndarray,
    entry_of: np.ndarray,
    key_of: np.ndarray,
    p: np.ndarray,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of positions in the order of their entries: counts of their keys, whether their
    contexts are states, and their probabilities, given those in the suffix state."""
    found = [answers[b] for b in sorted(answers)]
    none = np.empty(0, U)
    count = np.concatenate([none, *(unpack(x, U) for x, _ in found)]).astype(np.int64)
    state = np.concatenate([none, *(unpack(x, U) for _, x in found)]).astype(np.int64).reshape(-1, 3)
    names, values = corpus.split.get(depth, (np.empty(0, U), np.empty((0, 3), np.int64)))
    hot = np.flatnonzero(split)
    if len(names) and len(hot):
        where = np.minimum(np.searchsorted(names, split[hot]), len(names) - 1)
        state[hot] = np.where((names[where] == split[hot])[:, None], values[where], 0)
    n = np.where(key_of >= 0, np.append(count, 0)[key_of], 0)
    rest = (DISCOUNT * state[:, 1] + state[:, 2]) / np.maximum(state[:, 0], 1)
    total = state[:, 0][entry_of]
    is_state = total > 0
    smoothed = np.maximum(n - DISCOUNT, 0) / np.maximum(total, 1) + rest[entry_of] * p
    return n, is_state, np.where(is_state, smoothed, p)


def add_up(depth: int):
    """A bucket: counts of all keys, the states they make, an answer for each chunk."""

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        bucket = int(pdf["bucket"].iat[0])
        entries = [unpack(x, U) for x in pdf["entries"]]
        per = [unpack(x, np.uint32) for x in pdf["counts"]]
        all_entries, entry = np.unique(np.concatenate(entries), return_inverse=True)
        lone = np.bincount(entry, np.concatenate([unpack(x, np.uint32) for x in pdf["lone"]]), len(all_entries))
        split = np.zeros(len(all_entries), U)
        split[entry] = np.concatenate([unpack(x, U) for x in pdf["split"]])
        key_entry = np.repeat(entry, np.concatenate(per))
        key_next = np.concatenate([unpack(x, np.uint32) for x in pdf["next"]])
        seen = np.concatenate([unpack(x, np.uint32) for x in pdf["seen"]])
        parent = np.concatenate([unpack(x, np.uint8) for x in pdf["parent"]])
        order = in_order(key_entry, key_next)
        e, x = key_entry[order], key_next[order]
        new = np.append(True, (e[1:] != e[:-1]) | (x[1:] != x[:-1]))[: len(e)]
        key = np.empty(len(order), np.int64)
        key[order] = np.cumsum(new) - 1
        start = order[new]
        n = np.bincount(key, seen, len(start))
        e, log_parent = key_entry[start], parent[start] * (-np.log(2) / 8)
        size = len(all_entries)
        twice = n >= 2
        sums = np.stack(
            [
                np.bincount(e, n, size) + lone,  # occurrences
                np.bincount(e, n > 0, size),  # different next words
                lone,
                np.bincount(e, np.where(twice, n * (np.log(np.maximum(n - 1, 1)) - log_parent), 0), size),
                np.bincount(e, np.where(twice, n, 0), size),
                np.bincount(e, n == 1, size) + lone,
            ],
            axis=1,
        )
        states = np.where((split > 0)[:, None], 0, states_of(sums))
        rows = []
        at_entry = at_key = 0
        for chunk, own, counts in zip(pdf["chunk"], entries, per):
            keys = int(counts.sum())
            mine = states[entry[at_entry : at_entry + len(own)]].astype(U)
            rows.append((chunk, depth, bucket, pack(n[key[at_key : at_key + keys]].astype(U)), pack(mine.ravel())))
            at_entry, at_key = at_entry + len(own), at_key + keys
        parts = split > 0
        if parts.any():
            rows.append((-1, depth, bucket, pack(split[parts]), pack(sums[parts].ravel())))
        return pd.DataFrame(rows, columns=["chunk", "depth", "bucket", "counts", "states"])

    return work


def states_of(sums: np.ndarray) -> np.ndarray:
    """Occurrences, next words and lone words of contexts that are states, else zeros."""
    total, kinds, lone, gain, repeated, once = sums.T
    with np.errstate(divide="ignore", invalid="ignore"):
        rest = (DISCOUNT * kinds + lone) / total
        gain = gain - repeated * np.log(total) + np.where(once > 0, once * np.log(np.minimum(rest, 1)), 0)
    kept = (total >= LEAST) & (gain > GAIN)
    return np.where(kept[:, None], sums[:, :3], 0)


def add_words(pdf: pd.DataFrame) -> pd.DataFrame:
    """A bucket of words: the counts of all its chunks, and how many words were seen at all."""
    bucket = int(pdf["bucket"].iat[0])
    words = [unpack(x, U) for x in pdf["entries"]]
    _, word = np.unique(np.concatenate(words), return_inverse=True)
    total = np.bincount(word, np.concatenate([unpack(x, np.uint32) for x in pdf["counts"]])).astype(np.int64)
    rows, at = [], 0
    for chunk, own in zip(pdf["chunk"], words):
        rows.append((chunk, 0, bucket, pack(total[word[at : at + len(own)]].astype(U)), b""))
        at += len(own)
    rows.append((-1, 0, bucket, pack(np.array([total.sum(), (total > 0).sum()], np.int64)), b""))
    return pd.DataFrame(rows, columns=["chunk", "depth", "bucket", "counts", "states"])


def answers_of(row: dict) -> dict[int, dict[int, tuple[bytes, bytes]]]:
    """The answers that a chunk got, by depth and bucket."""
    answers: dict[int, dict[int, tuple[bytes, bytes]]] = {}
    for a in row["answers"] or []:
        answers.setdefault(a["depth"], {})[a["bucket"]] = (a["counts"], a["states"])
    return answers


def replayed(row: dict, corpus: Corpus, depth: int) -> Chunk:
    """A chunk with all answers so far, and its contexts of ``depth`` words."""
    chunk = Chunk(row)
    answers = answers_of(row)
    counts = np.concatenate([unpack(answers[0][b][0], U) for b in sorted(answers[0])])
    chunk.start(corpus, counts)
    for k in range(1, depth + 1):
        chunk.extend(k, corpus)
        if k < depth:
            chunk.learn(k, corpus, answers.get(k, {}))
    return chunk


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: tokens and log10 probabilities by words alone and by the tree.

    Learns from the rows that are not held out. Columns: doc_id, held_out, n_tokens,
    n_known, train_tokens, base_score, score.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text"), held_out(doc_id).alias("held_out"))
    chunks = written(to_chunks(rows), "lm-chunks")
    entries, tokens_bound = chunks.agg(F.sum("size"), F.count("*") * CHUNK).first()
    corpus = Corpus(max(1, -(-(entries or 0) // BUCKET)))

    def send_words(batches):
        for row in rows_of(batches):
            chunk = Chunk(row)
            counts, edges = chunk.word_counts(), buckets_of(chunk.words, corpus.buckets)
            sent = [
                [int(b), chunk.number, pack(chunk.words[edges[b] : edges[b + 1]]), pack(counts[edges[b] : edges[b + 1]])]
                for b in np.flatnonzero(np.diff(edges))
            ]
            yield message_batch([row + [b""] * 5 for row in sent])

    sent = chunks.mapInArrow(send_words, MESSAGES)
    answers = written(sent.groupBy("bucket").applyInPandas(add_words, ANSWERS), "lm-answers", ROWS)
    totals = [unpack(r["counts"], np.int64) for r in answers.where("chunk = -1").select("counts").collect()]
    corpus = Corpus(max(1, -(-tokens_bound // BUCKET)), *(int(sum(t[k] for t in totals)) for k in (0, 1)))

    for depth in range(1, DEPTH + 1):
        last = depth == DEPTH
        sent = with_answers(chunks, answers).mapInArrow(sender(corpus, depth, last), LAST_MESSAGES if last else MESSAGES)
        if last:
            sent = written(sent, "lm-last", ROWS)
        found = sent.where("bucket >= 0").select(*names_of(MESSAGES)).groupBy("bucket").applyInPandas(add_up(depth), ANSWERS)
        found = written(found, "lm-answers", ROWS)
        corpus.split[depth] = split_states(found)
        answers = answers.unionByName(found)

    def finish(batches):
        for row in rows_of(batches):
            entries = unpack(row["counts"], np.uint32)
            entry_of = np.repeat(np.arange(len(entries)), entries)
            split, key_of = unpack(row["split"], U), unpack(row["next"], np.int32)
            doc, p = unpack(row["seen"], np.uint32), unpack(row["parent"], np.float64)
            _, _, p = settle(DEPTH, corpus, answers_of(row).get(DEPTH, {}), split, entry_of, key_of, p)
            docs = len(row["ids"])
            lengths, known, base, done = unpack(row["sums"], np.float64).reshape(4, docs)
            yield pa.record_batch(
                [
                    pa.array(row["ids"], pa.int64()),
                    pa.array(row["held"], pa.bool_()),
                    pa.array(lengths.astype(np.int64)),
                    pa.array(known.astype(np.int64)),
                    pa.array([corpus.tokens] * docs, pa.int64()),
                    pa.array(base),
                    pa.array(done + np.bincount(doc, np.log10(p), docs)),
                ],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    carried = sent.where("bucket = -1").drop("bucket", "entries", "lone")
    return written(with_answers(carried, found, "left").mapInArrow(finish, schema), "lm-scores", ROWS)


def sender(corpus: Corpus, depth: int, last: bool):
    def send(batches):
        for row in rows_of(batches):
            chunk = replayed(row, corpus, depth)
            rows = list(chunk.messages(corpus))
            if last:
                rows = [[*row, None, None, None] for row in rows] + [chunk.carried(corpus)]
            yield message_batch(rows, LAST_MESSAGES if last else MESSAGES)

    return send


def names_of(schema: str) -> list[str]:
    return [column.split()[0] for column in schema.split(", ")]


def message_batch(rows: list[list], schema: str = MESSAGES) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 7, pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.binary()]
    names = names_of(schema)
    return pa.record_batch([pa.array([r[i] for r in rows], kinds[i]) for i in range(len(names))], names)


def with_answers(chunks: DataFrame, answers: DataFrame, how: str = "inner") -> DataFrame:
    """Chunks, each with the answers it got: as many as there are buckets and depths."""
    answer = F.collect_list(F.struct("depth", "bucket", "counts", "states")).alias("answers")
    return chunks.join(answers.where("chunk <> -1").groupBy("chunk").agg(answer), "chunk", how)


def split_states(found: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The states among contexts that were split over buckets, by their hash."""
    parts = found.where("chunk = -1").select("counts", "states").collect()
    names = np.concatenate([np.empty(0, U), *(unpack(r["counts"], U) for r in parts)])
    sums = np.concatenate([np.empty(0), *(unpack(r["states"], np.float64) for r in parts)]).reshape(-1, 6)
    every, which = np.unique(names, return_inverse=True)
    total = np.stack([np.bincount(which, sums[:, k], len(every)) for k in range(6)], axis=1) if len(every) else sums
    return every, states_of(total).astype(np.int64)
