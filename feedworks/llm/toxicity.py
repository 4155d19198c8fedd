"""Toxicity of texts that may hide what they say.

Texts pass a noisy channel that writes letters as look-alikes (``1d10t``), sets them apart
(``i d i o t``, ``i - d - i``) or repeats them (``idiiiot``, ``iiddiioott``), also several of these at once
(``i d ! o t``, ``ii dd ii``). Where a text shows signs of it, the piece
becomes a lattice of what each character may stand for, and a Viterbi search under a
character trigram model finds the likeliest reading. Elsewhere a lattice has one
path only, the text itself, and no search is needed; that holds within a piece as well, so that
a long run without spaces costs no more than its length. The restored text is scored by
a logistic model over whole words, and over word beginnings with how many different words
of the text have them.

The trigrams are counted over all documents. They are made of 64 symbols: the letters a to z, space, one
for what is no letter, and 36 that the other letters share by their code points, which bounds the
model at 64**3 counts whatever is in the texts. The classifier is learned from labelled rows: at most ``sample`` of them, the ones with the
smallest hashes of their ids, whole texts. From these come the document counts
of the features by label, the features kept (the most telling, at most ``features``)
and the weights. What travels to the tasks is bounded by these numbers, whatever the input.
Scoring covers every row and the whole of its text, of any length, and sees nothing but the text.

Null and empty texts are scored by the intercept. Labels that are null, or whose document is
not there, teach nothing; a document labelled twice counts twice. Without any
labelled row every score is 0. Rows are scored one by one: ties and repeats change nothing.
An empty table gives an empty table. Columns named like an output are replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from feedworks.llm.common import slices, text_or_empty, written

#: What a character may stand for besides itself. Fixed values of the channel.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "*": "aeiou",
}
SEPARATORS = " .-_*"
#: Natural logs of how often the channel keeps, disguises, sets apart and repeats.
KEEP, DISGUISE, APART, REPEAT = math.log(0.9), math.log(0.05), math.log(0.2), math.log(0.2)

_hidden = "".join(re.escape(c) for c in LOOKALIKES)
_apart = re.escape(SEPARATORS)
_letter = r"[^\W\d_]"
_unit = "[^\\W_]|[" + "".join(re.escape(c) for c in LOOKALIKES if not c.isalnum() and c not in SEPARATORS) + "]"
#: Three characters or more, each up to four times, set apart by up to three separators each.
APART_UNITS = rf"({_unit})\1{{0,3}}(?:[{_apart}]{{1,3}}({_unit})\2{{0,3}}){{2,}}"
SET_APART = re.compile(rf"(?<![^\W_]){APART_UNITS}(?![^\W_])")
ALL_APART = re.compile(APART_UNITS)
#: A look-alike beside a letter; a character three times running, or three characters twice each.
LIKE = re.compile(rf"[{_hidden}](?:(?<={_letter}.)|(?={_letter}))", re.S)
AGAIN = re.compile(r"(.)\1(?:\1|(.)\2(.)\3)", re.S)
TWICE = re.compile(rf"(?:({_letter})\1){{3}}")
SPACE = re.compile(r"\s")
WORDS = re.compile(r"[^\W\d_]+").findall
#: Lengths of word beginnings that are features; whole words are as well.
BEGINNINGS = (4, 5, 6)
#: A word beginning is a feature for each of these numbers of different words that have it.
TIMES = (1, 2, 3, 5)
#: The G statistic from which a feature is told from chance (about four and a half deviations).
TELLING = 20.0
#: Characters of restored pieces that a task keeps, and features that it counts before it
#: passes the counts on. These bound memory, not results.
MEMO, COUNTED = 4_000_000, 150_000


#: The symbols of the character model. Letters beyond a to z share 36 of them.
OTHERS = 36
SYMBOLS = " #abcdefghijklmnopqrstuvwxyz" + "".join(chr(0xE000 + i) for i in range(OTHERS))


def symbol(c: str) -> str:
    """What the character model sees of a character of a word."""
    if "a" <= c <= "z":
        return c
    return chr(0xE000 + ord(c) % OTHERS) if c.isalpha() else "#"


class CharacterModel:
    """Smoothed character trigrams; words are framed by spaces."""

    def __init__(self, trigrams: dict[str, int]):
        self.three = trigrams
        self.two: Counter = Counter()
        self.one: Counter = Counter()
        for gram, n in trigrams.items():
            self.two[gram[:2]] += n
            self.one[gram[2]] += n
        self.total = sum(self.one.values())
        self.cost: dict[str, float] = {}

    def log_p(self, gram: str) -> float:
        found = self.cost.get(gram)
        if found is None:
            single = (self.one[gram[2]] + 0.1) / (self.total + 0.1 * (len(self.one) + 1))
            seen = self.two[gram[:2]]
            found = self.cost[gram] = math.log((self.three.get(gram, 0) + 5 * single) / (seen + 5))
        return found

    def restore(self, piece: str) -> str:
        """The likeliest reading of one piece of text (lower case)."""
        # State: the last two characters read. Kept for each: log probability and reading.
        paths: dict[str, tuple[float, tuple | None]] = {"  ": (0.0, None)}
        for options in lattice(piece):
            if len(paths) == 1 and len(options) == 1:
                # One way to go on: what it costs changes no choice.
                ((state, (_, so_far)),) = paths.items()
                for c in options[0][0]:
                    state, so_far = state[1] + (" " if c in SEPARATORS else symbol(c)), (c, so_far)
                paths = {state: (0.0, so_far)}
                continue
            reached: dict[str, tuple[float, tuple | None]] = {}
            for state, (p, so_far) in paths.items():
                for text, cost in options:
                    here, q, last = state, p + cost, so_far
                    for c in text:
                        known = " " if c in SEPARATORS else symbol(c)
                        q += self.log_p(here + known)
                        here = here[1] + known
                        last = (c, last)
                    best = reached.get(here)
                    if best is None or q > best[0]:
                        reached[here] = (q, last)
            paths = reached
        end = max(((p + self.log_p(state + " "), so_far) for state, (p, so_far) in paths.items()), key=lambda x: x[0])
        letters, at = [], end[1]
        while at is not None:
            letters.append(at[0])
            at = at[1]
        return "".join(reversed(letters))


def lattice(piece: str) -> list[list[tuple[str, float]]]:
    """For each run of one character: what it may have been, with the channel's log probability."""
    # Separators can go only where all characters are set apart by them.
    spaced = ALL_APART.fullmatch(piece) is not None
    twice = spaced or TWICE.search(piece) is not None
    steps: list[list[tuple[str, float]]] = []
    at = 0
    while at < len(piece):
        c = piece[at]
        end = at
        if spaced and c in SEPARATORS:
            while piece[end] in SEPARATORS:
                end += 1
            steps.append([("", APART), (piece[at:end], KEEP)])
            at = end
            continue
        while end < len(piece) and piece[end] == c:
            end += 1
        n = end - at
        at = end
        reads = [(c, KEEP)] + [(x, DISGUISE) for x in LOOKALIKES.get(c, "")]
        if n == 1:
            steps.append(reads)
        elif c.isalpha() and n > 2:
            steps.append([(c, REPEAT), (c * 2, REPEAT)])
        elif twice:
            steps.append([(c * n, KEEP * n)] + [(x, p + REPEAT) for x, p in reads])
        else:
            steps.extend([reads] * n)
    return steps


@dataclass
class ToxicityModel:
    """What was learned; small enough to travel with the code of every task."""

    trigrams: dict[str, int] = field(default_factory=dict)
    weights: dict[str, float] = field(default_factory=dict)
    intercept: float | None = None

    def score_all(self, texts: list[str]) -> np.ndarray:
        reader = Reader.of(self)
        return np.array([reader.score(text) for text in texts], float)


class Reader:
    """A model at work in a task."""

    _open: tuple[object, Reader] | None = None

    def __init__(self, model: ToxicityModel):
        self.model, self.characters, self.memo = model, CharacterModel(model.trigrams), {}
        self.held = 0
        marks = set(model.weights)
        self.words = {f[:-1] for f in marks if f.endswith("$")}
        heads = {f.partition("*")[0] for f in marks if not f.endswith("$")}
        self.heads = [(n, {h for h in heads if len(h) == n}) for n in BEGINNINGS]
        self.marks = marks

    @classmethod
    def of(cls, model: ToxicityModel) -> Reader:
        key = (model.intercept, tuple(model.weights.items()), len(model.trigrams))
        if cls._open is None or cls._open[0] != key:
            cls._open = (key, cls(model))
        return cls._open[1]

    def restored(self, text: str) -> str:
        text = SET_APART.sub(lambda match: self.reading(match.group()), text.lower())
        signs = [m.start() for m in LIKE.finditer(text)] + [m.start() for m in AGAIN.finditer(text) if m.group().isalpha()]
        if not signs:
            return text
        # The whole run around each sign; every character is looked at once.
        parts, done = [], 0
        for at in sorted(signs):
            if at < done:
                continue
            start = at
            while start > done and not text[start - 1].isspace():
                start -= 1
            end = SPACE.search(text, at)
            end = len(text) if end is None else end.start()
            parts += [text[done:start], self.reading(text[start:end])]
            done = end
        return "".join(parts) + text[done:]

    def reading(self, piece: str) -> str:
        found = self.memo.get(piece)
        if found is None:
            self.held += len(piece)
            if self.held > MEMO:
                self.memo.clear()
                self.held = len(piece)
            found = self.memo[piece] = self.characters.restore(piece)
        return found

    def features(self, text: str) -> set[str]:
        """The model's features that occur in a text."""
        words = set(WORDS(self.restored(text)))
        found = {w + "$" for w in words & self.words}
        for n, heads in self.heads:
            if heads:
                found |= counted(w[:n] for w in words if w[:n] in heads) & self.marks
        return found

    def score(self, text: str) -> float:
        if self.model.intercept is None:
            return 0.0
        z = self.model.intercept + sum(self.model.weights[f] for f in self.features(text))
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


def counted(heads) -> set[str]:
    """Features of word beginnings, one of which is given for each different word."""
    return {f"{h}*{k}" for h, n in Counter(heads).items() for k in TIMES if n >= k}


def all_features(words: set[str]) -> set[str]:
    found = {w + "$" for w in words}
    for n in BEGINNINGS:
        found |= counted(w[:n] for w in words if len(w) >= n)
    return found


def learn(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    text: str = "text",
    doc_id: str = "doc_id",
    sample: int = 12_000,
    features: int = 400,
) -> ToxicityModel:
    """A model from at most ``sample`` rows of ``labels`` (doc_id, label) and their texts."""
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
    chosen = (
        known.select(F.col(doc_id).alias("labelled"), (F.col(label) > 0).cast("int").alias("label"))
        .orderBy(F.xxhash64("labelled"), "labelled", "label")
        .limit(sample)
    )
    # Broadcast: two numbers for each of at most ``sample`` rows.
    taught = docs.select(F.col(doc_id).alias("id"), text_or_empty(text).alias("text"))
    taught = taught.join(F.broadcast(chosen), F.col("id") == F.col("labelled")).select("id", "text", "label")
    taught = written(taught, "toxicity-sample")
    totals = {r["label"]: r["n"] for r in taught.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not totals:
        return ToxicityModel()
    positive, negative = totals.get(1, 0), totals.get(0, 0)
    model = ToxicityModel(trigrams=_trigrams(docs.select(text_or_empty(text).alias("text"))), intercept=math.log((positive + 0.5) / (negative + 0.5)))
    if not positive or not negative:
        return model
    model.weights = dict.fromkeys(_telling(taught, model, positive, negative, features), 0.0)
    if model.weights:
        _fit(model, taught)
    return model


def _batch(**columns: pa.Array) -> pa.RecordBatch:
    return pa.record_batch(list(columns.values()), list(columns))


def _symbol_table() -> np.ndarray:
    """The number of each code point's symbol: 0 for white space."""
    places = {c: i for i, c in enumerate(SYMBOLS)}
    return np.array([0 if chr(i).isspace() else places[symbol(chr(i))] for i in range(0x110000)], np.uint8)


def _trigrams(texts: DataFrame) -> dict[str, int]:
    """How often each run of three symbols is in the words of all texts, each framed as two spaces, word, space."""

    def count(batches):
        table, most = _symbol_table(), len(SYMBOLS)
        found = np.zeros(most**3, np.int64)
        for part in (part for batch in batches for part in slices(batch)):
            text = " ".join(["", *part.column("text").to_pylist(), ""]).lower()
            s = table[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)].astype(np.int64)
            s = s[np.concatenate(([True], (s[1:] != 0) | (s[:-1] != 0)))]
            s = np.repeat(s, np.where(s == 0, 2, 1))
            found += np.bincount((s[:-2] * most + s[1:-1]) * most + s[2:], minlength=most**3)
        found = found.reshape(most, most, most)
        found[:, 0, 0] = 0  # from one word's frame to the next one's
        seen = np.flatnonzero(found)
        grams = ["".join(SYMBOLS[k] for k in at) for at in zip(*np.unravel_index(seen, found.shape))]
        yield _batch(gram=pa.array(grams, pa.string()), n=pa.array(found.ravel()[seen], pa.int64()))

    counts = texts.mapInArrow(count, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return {r["gram"]: r["n"] for r in counts.collect()}  # at most len(SYMBOLS)**3 rows


def _telling(taught: DataFrame, model: ToxicityModel, positive: int, negative: int, most: int) -> list[str]:
    """The features that tell the labels apart best, by their documents of either label."""

    def sent(found: tuple[Counter, Counter]):
        for y in (0, 1):
            yield _batch(
                feature=pa.array(found[y].keys(), pa.string()),
                label=pa.array([y] * len(found[y]), pa.int32()),
                n=pa.array(found[y].values(), pa.int64()),
            )
            found[y].clear()

    def count(batches):
        reader = Reader.of(model)
        found: tuple[Counter, Counter] = (Counter(), Counter())
        for part in (part for batch in batches for part in slices(batch)):
            for t, y in zip(part.column("text").to_pylist(), part.column("label").to_pylist()):
                found[y].update(all_features(set(WORDS(reader.restored(t)))))
                if len(found[y]) > COUNTED:  # partial counts are as good
                    yield from sent(found)
        yield from sent(found)

    counts = (
        taught.select("text", "label")
        .mapInArrow(count, "feature string, label int, n long")
        .groupBy("feature")
        .agg(F.sum(F.col("n") * F.col("label")).alias("p"), F.sum(F.col("n") * (1 - F.col("label"))).alias("q"))
    )
    # How far the counts are from those of a feature that tells nothing (the G statistic). Very
    # many features are tried, so much is asked; only what speaks for the label is kept.
    p, q, all_rows = F.col("p"), F.col("q"), positive + negative

    def term(seen: Column, share: Column, rows: int) -> Column:
        return F.when(seen > 0, seen * F.log(seen * all_rows / (share * rows))).otherwise(0.0)

    having, lacking = p + q, F.lit(all_rows) - p - q
    telling = 2 * (
        term(p, having, positive)
        + term(q, having, negative)
        + term(positive - p, lacking, positive)
        + term(negative - q, lacking, negative)
    )
    speaks_for = p * negative > q * positive
    best = counts.withColumn("telling", telling).where(speaks_for & (F.col("telling") >= TELLING))
    best = best.orderBy(F.desc("telling"), "feature").limit(most)
    return [r["feature"] for r in best.select("feature").collect()]


def _fit(model: ToxicityModel, taught: DataFrame) -> None:
    """Logistic regression, ridge penalty, on distinct feature sets with their counts."""

    def find(batches):
        reader = Reader.of(model)
        for part in (part for batch in batches for part in slices(batch)):
            sets = [" ".join(sorted(reader.features(t))) for t in part.column("text").to_pylist()]
            yield _batch(found=pa.array(sets, pa.string()), label=part.column("label"))

    rows = (
        taught.select("text", "label")
        .mapInArrow(find, "found string, label int")
        .groupBy("found", "label")
        .agg(F.count("*").alias("n"))
        .orderBy("found", "label")
        .collect()  # at most one row per row of the sample
    )
    names = {f: i for i, f in enumerate(model.weights)}
    x = np.zeros((len(rows), len(names) + 1))
    x[:, -1] = 1
    for k, row in enumerate(rows):
        x[k, [names[f] for f in row["found"].split()]] = 1
    y = np.array([r["label"] for r in rows], float)
    n = np.array([r["n"] for r in rows], float)
    kept = np.arange(x.shape[1])
    while True:
        w = _weights(x[:, kept], y, n, model.intercept)
        # Every feature speaks for the label by itself: one that now speaks against it
        # only makes up for others that say the same, and goes.
        against = w[:-1] < 0
        if not against.any():
            break
        kept = kept[np.append(~against, True)]
    found = list(names)
    model.weights = {found[i]: float(v) for i, v in zip(kept[:-1], w) if v > 0}
    model.intercept = float(w[-1])


def _weights(x: np.ndarray, y: np.ndarray, n: np.ndarray, start: float, penalty: float = 0.1) -> np.ndarray:
    """Weights that minimise the penalised loss; the last column of ``x`` is the intercept.

    Each step takes the curvature at its largest, so that the loss falls every time.
    """
    w = np.zeros(x.shape[1])
    w[-1] = start
    ridge = np.full(len(w), penalty)
    ridge[-1] = 1e-6
    inverse = np.linalg.inv((x * (n / 4)[:, None]).T @ x + np.diag(ridge))
    for _ in range(100_000):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        step = inverse @ (x.T @ (n * (p - y)) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-4:
            return w
    raise ArithmeticError("the weights of the classifier do not settle")


def score(df: DataFrame, model: ToxicityModel, text: str = "text", out: str = "score") -> DataFrame:
    """``df`` with the probability that a text is toxic as ``out``."""

    @F.arrow_udf(DoubleType())
    def scored(batch: pa.Array) -> pa.Array:
        scores = [model.score_all(part.to_pylist()) for part in slices(batch)]
        return pa.array(np.concatenate([np.empty(0), *scores]), pa.float64())

    return df.withColumn(out, scored(text_or_empty(text)))


def held_out(doc_id: str | Column = "doc_id", of: int = 4, remainder: int = 2) -> Column:
    """Whether a row is kept for measuring: by the checksum of its id as text."""
    name = F.coalesce((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string"), F.lit(""))
    return F.crc32(name.cast("binary")) % of == remainder
