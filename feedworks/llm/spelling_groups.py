"""Grouping spelling variants: words at one edit from each other, found by Gram matrices.

Two words are near if one inserted, deleted or replaced letter turns one into the other. The
squared distance of their letter counts is then at most two, and lengths differ by one at
most. Letter counts of a block of words make a matrix; its product with itself gives all squared
distances of the block at once, and only pairs at most two apart are compared letter by letter.

Blocks. Near words share the first or the last half of their letters, whichever side of the
edit is longer; so a word goes to blocks by that half, once for its own length and once as
the shorter word of the next length. Words that share too common a half are dealt again
by half of what is left of them, as often as needed, so no block is large and none is compared
with all others. Blocks with few words are put together into one matrix.

A word's form is the most frequent near word, if that is ``ratio`` times as frequent or
more; ``root`` is where following forms ends.

* Null words and counts that are null take no part; a word given twice counts once, with the
  sum of its counts.
* Letters are code points; words need ``least`` of them. Any letters are allowed: those beyond the
  first 256 code points are counted by their remainder, which only lets more pairs through to the comparison.
* Of equally frequent near words the smallest in code-point order is the form.
* An empty table gives an empty result. Other columns of the input are not carried over.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedworks.llm.common import slices, written

#: Words of one block, and rows of one matrix.
BLOCK = 1024
#: Different words that a task counts before it passes them on.
HELD = 200_000
LOWER = {upper: upper + 32 for upper in range(ord("A"), ord("Z") + 1)}
RUN = re.compile("[A-Za-zÀ-ÿ]+")


def lower_ascii(text: str) -> str:
    return text.lower() if text.isascii() else text.translate(LOWER)


def count_runs(docs: DataFrame, doc_id: str, text: str, least: int, drop: int | None = None) -> DataFrame:
    """Words (word, n): maximal runs of Latin letters, A-Z in lower case, of ``least`` letters or more.

    ``drop`` plants typing errors: where it divides the crc32 of ``<doc_id>:<run>``, the letter
    at that crc32 modulo the run's length is left out (a null id is written ``null``). Null texts have no words. A task
    adds up its own words before they are shuffled.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def told() -> pa.RecordBatch:
            out = pa.record_batch([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])
            seen.clear()
            return out

        for batch in batches:
            for part in slices(batch):
                for doc, body in zip(part.column("doc").to_pylist(), part.column("text").to_pylist()):
                    start = zlib.crc32(f"{doc}:".encode())
                    for run, n in Counter(RUN.findall(lower_ascii(body))).items():
                        if len(run) < least:
                            continue
                        if drop is not None:
                            h = zlib.crc32(run.encode(), start)
                            if h % drop == 0:
                                at = h % len(run)
                                run = run[:at] + run[at + 1 :]
                                if len(run) < least:
                                    continue
                        seen[run] += n
                if len(seen) > HELD:
                    yield told()
        yield told()

    texts = docs.where(F.col(text).isNotNull()).select(
        F.coalesce(F.col(doc_id).cast("string"), F.lit("null")).alias("doc"), F.col(text).alias("text")
    )
    counted = texts.mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def one_edit(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced letter turns one word into the other."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + 1 :] == b[at + 1 :] if len(a) == len(b) else a[at:] == b[at + 1 :]


def near_in_block(words: list[str], blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i < j) of words of one block that are one edit apart, from the Gram matrix of their letter counts."""
    lengths = np.array([len(w) for w in words])
    letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32) & 255
    used, letter = np.unique(letters, return_inverse=True)
    counts = np.zeros((len(words), len(used)), np.float32 if lengths.max() < 2000 else np.float64)
    np.add.at(counts, (np.repeat(np.arange(len(words)), lengths), letter), 1)
    square = (counts * counts).sum(axis=1)
    distance = square[:, None] + square[None, :] - 2 * (counts @ counts.T)
    close = (distance <= 2) & (blocks[:, None] == blocks[None, :]) & (abs(lengths[:, None] - lengths[None, :]) <= 1)
    i, j = np.nonzero(np.triu(close, 1))
    near = np.fromiter((one_edit(words[a], words[b]) for a, b in zip(i.tolist(), j.tolist())), bool, len(i))
    return i[near], j[near]


def _halved(nodes: DataFrame) -> DataFrame:
    """Every word once by the first and once by the last half of what its block does not share yet."""
    # Of ``left`` letters of the longer word of a pair one is edited; half of the others are on one side.
    left = F.col("longer") - F.length("head") - F.length("tail")
    half = F.ceil((left - 1) / 2).cast("int")
    rest = F.length("rest")
    first = nodes.select(
        "word",
        "n",
        "longer",
        F.concat("head", F.substring(F.col("rest"), F.lit(1), half)).alias("head"),
        F.substring(F.col("rest"), half + 1, rest).alias("rest"),
        "tail",
    )
    last = nodes.select(
        "word",
        "n",
        "longer",
        "head",
        F.substring(F.col("rest"), F.lit(1), rest - half).alias("rest"),
        F.concat(F.substring(F.col("rest"), rest - half + 1, half), "tail").alias("tail"),
    )
    return first.unionByName(last)


def _blocks(words: DataFrame) -> DataFrame:
    """Rows (word, n, block): words that are near share a block, and few blocks have more than BLOCK words."""
    key = ["longer", "head", "tail"]
    nodes = words.select(
        "word",
        "n",
        F.explode(F.array(F.length("word"), F.length("word") + 1)).alias("longer"),
        F.lit("").alias("head"),
        F.col("word").alias("rest"),
        F.lit("").alias("tail"),
    )
    done = []
    nodes = written(_halved(nodes), "spelling-blocks")
    while True:
        # Two letters or fewer that differ are compared as they are: such a block has each of them once.
        full = nodes.groupBy(*key).agg(F.count("*").alias("size"))
        full = full.where((F.col("size") > BLOCK) & (F.col("longer") - F.length("head") - F.length("tail") > 2))
        full = written(full, "spelling-full")
        if full.isEmpty():
            done.append(nodes)
            break
        done.append(nodes.join(full, key, "left_anti"))
        nodes = written(_halved(nodes.join(full.select(*key), key, "left_semi")), "spelling-blocks")
    every = done[0]
    for more in done[1:]:
        every = every.unionByName(more)
    return every.select("word", "n", F.concat_ws("\u0001", *key).alias("block"))


def near_words(words: DataFrame) -> DataFrame:
    """Rows (word, n, near, near_n) for every ordered pair of near words of ``words`` (word, n), each once."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[str, int, str]] = []

        def pairs() -> pa.RecordBatch:
            names = [w for w, _, _ in held]
            n = np.array([c for _, c, _ in held], np.int64)
            numbers: dict[str, int] = {}
            block = np.array([numbers.setdefault(b, len(numbers)) for _, _, b in held])
            i, j = near_in_block(names, block)
            a, b = np.concatenate((i, j)), np.concatenate((j, i))
            name = pa.array(names, pa.string())
            return pa.record_batch([name.take(pa.array(a)), pa.array(n[a]), name.take(pa.array(b)), pa.array(n[b])], ["word", "n", "near", "near_n"])

        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("word", "n", "block")))
            for row in rows:
                if len(held) >= BLOCK and row[2] != held[-1][2]:
                    # Whole blocks only: the last one may still be growing.
                    yield pairs()
                    held = []
                held.append(row)
        if held:
            yield pairs()

    partitions = words.sparkSession.conf.get("spark.sql.shuffle.partitions")
    sorted_blocks = _blocks(words).repartition(int(partitions), "block").sortWithinPartitions("block")
    # A pair that shares both halves is found in two blocks.
    return sorted_blocks.mapInArrow(compare, "word string, n long, near string, near_n long").distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """Rows (word, root) of words (word, form): where following forms ends.

    Each form is many times as frequent as its word, so chains are short; every round
    doubles how far a root is.
    """
    roots = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = roots.join(onward, "root", "left")
        if joined.where(F.col("further").isNotNull()).isEmpty():
            return roots
        roots = written(joined.select("word", F.coalesce("further", "root").alias("root")), "spelling-roots")


def group_spellings(counts: DataFrame, ratio: int = 10, least: int = 7) -> DataFrame:
    """Words (word, n) of ``counts`` with their ``form``, ``root``, ``n_near`` and ``form_n``."""
    words = counts.where(F.col("word").isNotNull() & F.col("n").isNotNull()).groupBy("word").agg(F.sum("n").alias("n"))
    words = written(words.where(F.length("word") >= least), "spelling-words")
    near = near_words(words)
    best = near.groupBy("word", "n").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    formed = F.col("best.less") <= -ratio * F.col("n")
    known = written(
        best.select(
            "word",
            "n_near",
            F.when(formed, F.col("best.near")).alias("form"),
            F.when(formed, -F.col("best.less")).alias("form_n"),
        ),
        "spelling-forms",
    )
    roots = _roots(known.where(F.col("form").isNotNull()))
    told = words.join(known.join(roots, "word", "left"), "word", "left")
    return told.select(
        "word",
        "form",
        F.coalesce("root", "word").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        "form_n",
    )
