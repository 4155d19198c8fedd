"""Removing passages that an earlier document has, found with suffix automata of reference shards.

A window is ``window`` consecutive words of a document; a word goes if a window that covers it
also starts in a document with a smaller id. Maximal spans of such words are what is removed.

Every window has a mark: the smallest hash among its runs of a few words. Equal windows have
equal marks, and neighbouring windows mostly share theirs, so a text falls into passages of
windows with one mark. Only passages whose mark occurs in two documents can matter; their words
go to the reference shard of their mark. There they are streamed, by ascending document,
through the suffix automaton of all passages of smaller documents: where the matching
statistic, the longest suffix that the automaton knows, reaches ``window``, an earlier document
has that window. So an automaton meets all passages that can match it and no others. It is
not sent to every document: with shards in proportion to the corpus, all documents
against all shards would be quadratic.

Sizes. A chunk (a few MB of neighbouring documents) sends each of its passages once, with its
smallest document, so a passage in a third of all documents is one row per chunk. A mark with
very many different passages is cut into single windows, dealt by their own hashes. Shards
follow the number of passages; texts are never shuffled.

* Null texts have no words. Rows with a null id lose nothing and take nothing away.
* Rows that repeat an id are judged each by its own text; equal ids are not smaller, so such
  rows leave each other alone, whether their texts are equal or not.
* A window that a document repeats within itself stays.
* Texts may be of any length that fits into a cell; texts under ``window`` words stay whole.
* An empty table gives an empty result.
* Other columns pass through; where one has the name of a result column, that result column
  gets underscores before its name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from feedworks.llm.buckets import bucketed
from feedworks.llm.common import free_name, give_back, written
from feedworks.llm.hashing import BACK, BASE, U, mixed, powers, word_hashes

#: Bytes of text in a chunk, passages in a shard, and passages of one mark before it is cut.
CHUNK, SHARD, HEAVY = 8 << 20, 20_000, 2_000
STEP = 0xD6E8FEB86659FD93


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a text, given as its bytes, begin and end."""
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edges = np.flatnonzero(np.diff(np.concatenate(([True], space, [True]))))
    return edges[::2], edges[1::2]


def run_keys(sums: np.ndarray, start: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hashes of runs of words, from the running sums of ``passages``."""
    if not len(start):
        return np.empty(0, U)
    back = powers(BACK, int(start.max()) + 1)
    return mixed((sums[start + words] - sums[start]) * back[start] + words.astype(U))


def passages(h: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Passages of a text with these word hashes: first window, number of windows, mark; running sums for keys."""
    sums = np.zeros(len(h) + 1, U)
    if len(h) < window:
        none = np.empty(0, np.int64)
        return none, none, np.empty(0, U), sums
    np.cumsum(h * powers(BASE, len(h)), out=sums[1:])
    k = max(1, window // 2 - 1)
    n = len(h) - k + 1
    grams = np.zeros(n, U)
    for j in range(k):
        grams += h[j : j + n] * U(pow(STEP, j, 1 << 64))
    grams = mixed(grams)
    around = np.lib.stride_tricks.sliding_window_view(grams, window - k + 1)
    at = around.argmin(axis=1) + np.arange(len(around))
    start = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    count = np.diff(np.concatenate((start, [len(at)])))
    return start, count, grams[at[start]], sums


class SuffixAutomaton:
    """All substrings of the passages added so far, over words."""

    def __init__(self):
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]

    def _state(self, moves: dict[bytes, int], link: int, length: int) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        return len(self.length) - 1

    def _split(self, p: int, word: bytes, q: int) -> int:
        """The state of exactly the strings of ``p`` and a word, taken out of ``q`` if that has longer ones."""
        if self.length[q] == self.length[p] + 1:
            return q
        own = self._state(dict(self.next[q]), self.link[q], self.length[p] + 1)
        self.link[q] = own
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = own
            p = self.link[p]
        return own

    def add(self, words: list[bytes]) -> None:
        last = 0
        for word in words:
            p, known = last, self.next[last].get(word)
            if known is not None:
                last = self._split(p, word, known)
                continue
            new = self._state({}, 0, self.length[last] + 1)
            while p >= 0 and word not in self.next[p]:
                self.next[p][word] = new
                p = self.link[p]
            if p >= 0:
                self.link[new] = self._split(p, word, self.next[p][word])
            last = new

    def statistics(self, words: list[bytes]) -> list[int]:
        """For each word the length of the longest run, ending there, that a passage has."""
        moves, link, length = self.next, self.link, self.length
        state = matched = 0
        out = []
        for word in words:
            while state and word not in moves[state]:
                state = link[state]
                matched = length[state]
            if word in moves[state]:
                state, matched = moves[state][word], matched + 1
            out.append(matched)
        return out


def earlier_windows(firsts: list[tuple[int, bytes]], window: int) -> dict[bytes, bytes]:
    """Of passages (smallest document, words), the numbers of windows that one of a smaller document has."""
    automaton, found, at = SuffixAutomaton(), {}, 0
    firsts = sorted(firsts)
    while at < len(firsts):
        to = at
        while to < len(firsts) and firsts[to][0] == firsts[at][0]:
            to += 1
        split = [passage.split(b" ") for _, passage in firsts[at:to]]
        for (_, passage), words in zip(firsts[at:to], split):
            ends = [i - window + 1 for i, m in enumerate(automaton.statistics(words)) if m >= window]
            if ends:
                found[passage] = bytes(ends)
        for words in split:
            automaton.add(words)
        at = to
    return found


class Chunk:
    """The passages of some documents, one after the other in arrays."""

    def __init__(self, ids: list, texts: list, window: int):
        parts: list[tuple] = []
        self.data: dict[int, np.ndarray] = {}
        for i, (doc, text) in enumerate(zip(ids, texts)):
            if doc is None or not text:
                continue
            data = np.frombuffer(text, np.uint8)
            start, count, mark, sums = passages(word_hashes(data), window)
            if len(start):
                self.data[i] = data
                keys = run_keys(sums, start, count + (window - 1))
                parts.append((start, count, mark, keys, np.full(len(start), doc), np.full(len(start), i)))
        none = [np.empty(0, t) for t in (np.int64, np.int64, U, U, np.int64, np.int64)]
        columns = [np.concatenate(c) for c in zip(*parts)] if parts else none
        self.start, self.count, self.mark, self.key, self.doc, self.row = columns

    def only(self, kept: np.ndarray) -> None:
        for name in ("start", "count", "mark", "key", "doc", "row"):
            setattr(self, name, getattr(self, name)[kept])


class Verdicts:
    """What shards say of the passages of a chunk: their smallest documents, and windows that earlier ones have."""

    def __init__(self, rows: pa.Table):
        keys = rows.column("key").to_numpy().view(U)
        order = np.argsort(keys)
        self.keys, self.first = keys[order], rows.column("first").to_numpy()[order]
        windows = rows.column("windows").to_pylist()
        self.windows = [windows[i] for i in order.tolist()]
        #: Marks whose passages were cut into windows.
        self.cut = np.unique(rows.column("cut").drop_null().to_numpy().view(U))

    def covered(self, doc: int, text: bytes | None, window: int) -> np.ndarray | None:
        """Which words of a document go, None if none does."""
        h = word_hashes(np.frombuffer(text or b"", np.uint8))
        start, count, mark, sums = passages(h, window)
        if not len(start):
            return None
        if len(self.cut):
            at = np.searchsorted(self.cut, mark)
            at[at == len(self.cut)] = 0
            cut = self.cut[at] == mark
            if cut.any():
                each = np.where(cut, count, 1)
                shift = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
                start, count = np.repeat(start, each) + shift, np.repeat(np.where(cut, 1, count), each)
        own = run_keys(sums, start, count + (window - 1))
        at = np.searchsorted(self.keys, own)
        at[at == len(self.keys)] = 0
        hit = np.flatnonzero(self.keys[at] == own)
        whole = hit[self.first[at[hit]] < doc]
        change = np.zeros(len(h) + 1, np.int64)
        np.add.at(change, start[whole], 1)
        np.add.at(change, start[whole] + count[whole] + window - 1, -1)
        some = False
        for i in hit[self.first[at[hit]] == doc].tolist():
            for w in self.windows[at[i]]:
                change[start[i] + w] += 1
                change[start[i] + w + window] -= 1
                some = True
        return np.cumsum(change)[:-1] > 0 if some or len(whole) else None


def bytes_of(column: pa.Array | pa.ChunkedArray) -> list:
    return column.cast(pa.binary()).to_pylist()


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def remove_earlier_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = 13) -> DataFrame:
    """The rows of ``docs`` with ``text`` reduced to the words that stay, joined by single spaces.

    Adds ``n_words`` and ``n_removed`` (long), and ``removed``, the maximal spans of words that went, as
    (from, to) with words counted from 0 and ``to`` excluded. ``window`` is 2 to 200.
    """
    if not 2 <= window <= 200:
        raise ValueError("a window has 2 to 200 words")
    carried = [c for c in docs.columns if c != text]
    names = {name: free_name(docs, name) for name in ("n_words", "n_removed", "removed")}
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text"), F.struct(*carried).alias("row")
    )
    row = rows.schema["row"]
    chunked = StructType([StructField("chunk", LongType()), *rows.schema.fields])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, held = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            sizes = np.array([len(t or b"") for t in bytes_of(batch.column("text"))], np.int64)
            chunk = base + (held + np.cumsum(sizes)) // CHUNK
            held += int(sizes.sum())
            yield pa.record_batch([pa.array(chunk), *batch.columns], ["chunk", *batch.schema.names])

    dealt = bucketed(rows.mapInArrow(number, chunked), "repeat-chunks", "chunk")

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunks = batch.column("chunk").to_numpy()
            cuts = np.flatnonzero(np.concatenate(([True], chunks[1:] != chunks[:-1], [True])))
            for a, b in zip(cuts, cuts[1:]):
                part = batch.slice(a, b - a)
                own = Chunk(part.column("doc").to_pylist(), bytes_of(part.column("text")), window)
                order = np.lexsort((own.key, own.mark))
                marks, keys, doc = own.mark[order], own.key[order], own.doc[order]
                first = np.flatnonzero(np.concatenate(([True], marks[1:] != marks[:-1]))) if len(marks) else order
                if not len(first):
                    continue
                new = np.concatenate(([True], (marks[1:] != marks[:-1]) | (keys[1:] != keys[:-1])))
                columns = [
                    signed(marks[first]),
                    pa.array(np.full(len(first), chunks[a])),
                    pa.array(np.minimum.reduceat(doc, first)),
                    pa.array(np.maximum.reduceat(doc, first)),
                    pa.array(np.add.reduceat(new.astype(np.int64), first)),
                ]
                yield pa.record_batch(columns, ["mark", "chunk", "least", "most", "passages"])
            give_back()

    marks = dealt.select("chunk", "doc", "text").mapInArrow(mark, "mark long, chunk long, least long, most long, passages long")
    # At most one row per mark, chunk and batch, so that no mark has many.
    same = Window.partitionBy("mark")
    hits = (
        marks.select(
            "mark",
            "chunk",
            F.min("least").over(same).alias("least"),
            F.max("most").over(same).alias("most"),
            (F.sum("passages").over(same) > HEAVY).alias("heavy"),
        )
        .where("least < most")
        .select("chunk", "mark", "heavy")
    )

    def passage_rows(key, left: pa.Table, right: pa.Table) -> pa.Table:
        wanted, at = np.unique(right.column("mark").to_numpy(), return_index=True)
        heavy = right.column("heavy").to_numpy()[at]
        own = Chunk(left.column("doc").to_pylist(), bytes_of(left.column("text")), window)
        place = np.searchsorted(wanted, own.mark.view(np.int64))
        place[place == len(wanted)] = 0
        own.only(np.flatnonzero(wanted[place] == own.mark.view(np.int64)) if len(wanted) else [])
        cut = heavy[np.searchsorted(wanted, own.mark.view(np.int64))] if len(wanted) else np.zeros(0, bool)
        route = own.mark.copy()
        single = np.zeros(len(route), bool)
        if cut.any():
            # Every window by itself: its key is made as that of a passage of one window.
            reps = np.where(cut, own.count, 1)
            again = np.repeat(np.arange(len(cut)), reps)
            shift = np.arange(len(again)) - np.repeat(np.cumsum(reps) - reps, reps)
            single = cut[again]
            own.only(again)
            own.start = own.start + shift
            own.count = np.where(single, 1, own.count)
            for i in np.unique(own.row[single]):
                mine = np.flatnonzero(single & (own.row == i))
                h = word_hashes(own.data[int(i)])
                sums = passages(h, window)[3]
                own.key[mine] = run_keys(sums, own.start[mine], np.full(len(mine), window))
            route = np.where(single, own.key, own.mark)
        order = np.lexsort((own.doc, own.key))
        first = np.flatnonzero(np.concatenate(([True], own.key[order][1:] != own.key[order][:-1]))) if len(order) else order
        one = order[first]
        words: list = [None] * len(one)
        rows_of = own.row[one]
        by_row = np.argsort(rows_of, kind="stable")
        spans: tuple = ()
        last = -1
        for j in by_row.tolist():
            i = int(rows_of[j])
            if i != last:
                last, spans = i, word_spans(own.data[i])
            a, b = own.start[one[j]], own.start[one[j]] + own.count[one[j]] + window - 2
            words[j] = b" ".join(own.data[i][spans[0][a] : spans[1][b]].tobytes().split())
        doc = own.doc[order]
        columns = [
            signed(route[one]),
            pa.array(np.full(len(one), key[0].as_py())),
            signed(own.key[one]),
            pa.array(own.mark[one].view(np.int64), pa.int64(), mask=~single[one]),
            pa.array(doc[first]),
            pa.array(np.maximum.reduceat(doc, first) if len(first) else doc),
            pa.array(words, pa.binary()),
        ]
        give_back()
        return pa.table(columns, ["route", "chunk", "key", "cut", "least", "most", "words"])

    chunks = dealt.select("chunk", "doc", "text").groupBy("chunk")
    found = written(
        chunks.cogroup(hits.groupBy("chunk")).applyInArrow(
            passage_rows, "route long, chunk long, key long, cut long, least long, most long, words binary"
        ),
        "repeat-passages",
    )
    shards = max(1, -(-found.count() // SHARD))

    def judge(table: pa.Table) -> pa.Table:
        least, most = table.column("least").to_numpy(), table.column("most").to_numpy()
        words, route = table.column("words").to_pylist(), table.column("route").to_pylist()
        first: dict[bytes, int] = {}
        different: dict[int, set[bytes]] = {}
        for w, r, d in zip(words, route, least.tolist()):
            if first.setdefault(w, d) > d:
                first[w] = d
            different.setdefault(r, set()).add(w)
        # Where a mark has one passage only, no other can share its windows.
        several = {w for own in different.values() if len(own) > 1 for w in own}
        earlier = earlier_windows([(first[w], w) for w in several], window)
        firsts = np.array([first[w] for w in words], np.int64)
        masks = [earlier.get(w, b"") if f == d else b"" for w, f, d in zip(words, firsts.tolist(), least.tolist())]
        told = np.flatnonzero((firsts < most) | np.array([bool(m) for m in masks], bool))
        columns = [*(table.column(c).take(told) for c in ("chunk", "key", "cut")), pa.array(firsts[told])]
        give_back()
        return pa.table([*columns, pa.array([masks[i] for i in told], pa.binary())], ["chunk", "key", "cut", "first", "windows"])

    sharded = found.withColumn("shard", F.pmod(F.xxhash64("route"), F.lit(shards)))
    verdicts = written(
        sharded.groupBy("shard").applyInArrow(judge, "chunk long, key long, cut long, first long, windows binary"),
        "repeat-verdicts",
    )

    def removed(key, left: pa.Table, right: pa.Table) -> pa.Table:
        found = Verdicts(right)
        out: tuple[list, list, list, list] = ([], [], [], [])
        for doc, text in zip(left.column("doc").to_pylist(), bytes_of(left.column("text"))):
            words = (text or b"").split()
            gone = found.covered(doc, text, window) if doc is not None and len(found.keys) else None
            spans: list = []
            if gone is not None:
                edges = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False]))))
                spans = [{"from": a, "to": b} for a, b in edges.reshape(-1, 2).tolist()]
                stay = np.flatnonzero(~gone).tolist()
                out[0].append(b" ".join([words[i] for i in stay]))
            else:
                out[0].append(b" ".join(words))
            out[1].append(len(words))
            out[2].append(sum(s["to"] - s["from"] for s in spans))
            out[3].append(spans)
        give_back()
        span = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
        columns = [pa.array(out[0], pa.binary()).cast(pa.string()), *(pa.array(c, pa.int64()) for c in out[1:3])]
        return pa.table([left.column("row"), *columns, pa.array(out[3], span)], ["row", "kept", "n_words", "n_removed", "removed"])

    added = "kept string, n_words long, n_removed long, removed array<struct<from:bigint,to:bigint>>"
    result = dealt.groupBy("chunk").cogroup(verdicts.groupBy("chunk")).applyInArrow(
        removed, StructType([row, *StructType.fromDDL(added).fields])
    )
    columns = [F.col("kept").alias(text) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    return result.select(*columns, *(F.col(c).alias(name) for c, name in names.items()))
