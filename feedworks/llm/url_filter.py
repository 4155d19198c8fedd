"""URL filters as one bit-parallel wildcard automaton.

A rule is a glob over a canonical URL (here ``.host/path``): ``*`` stands for any run
of characters but ``/``, ``**`` for any run at all, ``?`` for one character but ``/``,
a backslash takes the next character as it is. All rules together are one Shift-And
automaton: rule by rule, each state is a bit of a row of 64-bit words. A character moves
every active state of every rule at once, ``(state << 1) & step[c] | state & stay[c]``,
with the shift carried from word to word. The automaton runs over a whole Arrow batch,
one character of all its URLs at a time, and stops once only states are left that
nothing can change any more. Of the rules that match, the one listed last wins, so
rules are listed from weakest to strongest.

Null and empty URLs are matched like any other text (null as empty); a URL may have any
length, as rows are walked in groups of bounded size. Rows are judged one by one: ties
and repeated rows change nothing. An existing column named like the output is replaced.
The rules are a parameter and travel with the code: their size is that of the list.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

#: Bytes of URL text that are laid out side by side at a time.
CELLS = 8 << 20
ONE = np.uint64(1)


def glob_tokens(glob: str) -> list[bytes | str]:
    """A glob as its single bytes and the wildcards ``*``, ``**`` and ``?``."""
    tokens: list[bytes | str] = []
    chars = iter(range(len(glob)))
    for i in chars:
        if glob[i] == "\\" and i + 1 < len(glob):
            tokens += [bytes([b]) for b in glob[next(chars)].encode()]
        elif glob.startswith("**", i):
            next(chars)
            tokens.append("**")
        elif glob[i] in "*?":
            tokens.append(glob[i])
        else:
            tokens += [bytes([b]) for b in glob[i].encode()]
    return tokens


class GlobAutomaton:
    """All globs packed into masks of as many 64-bit words as their states need."""

    def __init__(self, globs: Sequence[str]):
        step: list[tuple[int, set[int]]] = []
        stay: list[tuple[int, set[int]]] = []
        starts, ends, sinks = [], [], []
        slash, every = {ord("/")}, set(range(256))
        state = 0
        for glob in globs:
            starts.append(state)
            for token in glob_tokens(glob):
                if token == "**":
                    stay.append((state, every))
                elif token == "*":
                    stay.append((state, every - slash))
                else:
                    state += 1
                    step.append((state, every - slash if token == "?" else set(token)))
            ends.append(state)
            if glob_tokens(glob)[-1:] == ["**"]:
                sinks.append(state)
            state += 1
        self.words = state // 64 + 1
        # Column 256 is the end of a shorter URL: every state stays as it is.
        self.step = np.zeros((257, self.words), np.uint64)
        self.stay = np.zeros((257, self.words), np.uint64)
        self.stay[256] = ~np.uint64(0)
        for table, entries in ((self.step, step), (self.stay, stay)):
            for bit, chars in entries:
                table[sorted(chars), bit // 64] |= ONE << np.uint64(bit % 64)
        self.start = self.mask(starts)
        self.unsettled = ~self.mask(sinks)
        self.ends = ends

    def mask(self, bits: Sequence[int]) -> np.ndarray:
        out = np.zeros(self.words, np.uint64)
        for bit in bits:
            out[bit // 64] |= ONE << np.uint64(bit % 64)
        return out

    def run(self, data: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The last matching glob's number for each URL, -1 where none matches."""
        state = np.broadcast_to(self.start, (len(begins), self.words)).copy()
        for k in range(int(lengths.max(initial=0))):
            inside = k < lengths
            code = np.full(len(begins), 256)
            code[inside] = data[begins[inside] + k]
            shifted = state << ONE
            if self.words > 1:
                shifted[:, 1:] |= state[:, :-1] >> np.uint64(63)
            state = (shifted & self.step[code]) | (state & self.stay[code])
            if k % 8 == 7 and not (state[inside] & self.unsettled).any():
                break
        found = np.full(len(begins), -1, np.int32)
        for number, bit in enumerate(self.ends):
            hit = (state[:, bit // 64] >> np.uint64(bit % 64)) & ONE
            found[hit.astype(bool)] = number
        return found

    def match(self, urls: pa.Array) -> np.ndarray:
        urls = urls.cast(pa.large_binary())
        _, offsets, data = urls.buffers()
        ends = np.frombuffer(offsets, np.int64)[urls.offset : urls.offset + len(urls) + 1]
        data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(1, np.uint8)
        lengths = np.diff(ends)
        # URLs of like length walk together, so that short ones do not wait for long ones.
        order = np.argsort(lengths, kind="stable")
        found = np.empty(len(urls), np.int32)
        at = 0
        while at < len(order):
            size = max(1, CELLS // max(1, 8 * self.words))
            group = order[at : at + size]
            group = group[lengths[group] <= 2 * lengths[group[0]] + 64]
            found[group] = self.run(data, ends[group], lengths[group])
            at += len(group)
        return found


_automata: dict[tuple[str, ...], GlobAutomaton] = {}


def automaton(globs: tuple[str, ...]) -> GlobAutomaton:
    if globs not in _automata:
        _automata.clear()
        _automata[globs] = GlobAutomaton(globs)
    return _automata[globs]


def match_globs(df: DataFrame, url: str | Column, globs: Sequence[str], out: str = "rule_no") -> DataFrame:
    """``df`` with the number of the last glob that matches ``url``, null if none does."""
    patterns = tuple(globs)

    @F.arrow_udf(IntegerType())
    def matched(batch: pa.Array) -> pa.Array:
        found = automaton(patterns).match(batch)
        return pa.array(found, pa.int32(), mask=found < 0)

    return df.withColumn(out, matched(F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit(""))))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def literal(text: str) -> str:
    """A glob that matches just this text."""
    return "".join("\\" + c if c in "*?\\" else c for c in text)


def filter_urls(
    df: DataFrame, rules: Sequence[tuple[str, str]], url: str = "url", default: str = "allow"
) -> DataFrame:
    """``df`` with ``host``, ``path``, ``rule`` and ``verdict`` of every URL.

    ``rules`` are pairs of a verdict and ``host/path``: a rule fits its host and all
    subdomains where the URL's path starts with its own. The longest rule that fits
    gives the verdict, of equally long ones the first listed; ``default`` holds elsewhere.
    """
    ranked = sorted(enumerate(rules), key=lambda r: (len(r[1][1]), -r[0]))
    texts = [rule for _, (_, rule) in ranked]
    verdicts = [verdict for _, (verdict, _) in ranked]
    # The canonical URL starts with a dot, so that subdomains and the host itself match alike.
    globs = [f"*.{literal(rule)}**" for rule in texts]
    named = df.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    found = match_globs(named, F.concat(F.lit("."), F.col("host"), F.col("path")), globs, "rule")
    at = F.col("rule")
    return found.withColumn("verdict", _pick(verdicts, at, default)).withColumn("rule", _pick(texts, at, None))


def _pick(values: Sequence[str], at: Column, default: str | None) -> Column:
    if not values:
        return F.lit(default).cast("string")
    known = F.get(F.array(*map(F.lit, values)), at)
    return F.when(at.isNotNull(), known).otherwise(F.lit(default).cast("string"))
