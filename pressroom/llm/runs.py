"""Periodic runs of words, found with an enhanced suffix array.

A run of period q that ends at e holds the square of the 2q words before e, whose halves' suffixes agree
in exactly q words: it branches. In the suffix array both halves lie in the interval of suffixes that
share those q words, in different children of it. So for every interval of depth q the members of all
children but the largest are asked whether the suffixes q words on and q words back lie in the interval
too, by the inverse suffix array. Such squares are rotated to the left for as long as words agree, which
gives the run; squares of a multiple of its period fall into it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressroom.llm.common import SPACES, let

#: A run has at least so many words, and so many periods.
LEAST_WORDS, LEAST_PERIODS = 24, 3
#: Bytes of text whose words are in memory as Python objects at once, and of texts worked on together.
PIECE, SLICE = 1 << 20, 1 << 22
#: Members of intervals that are tested at once.
MEMBERS = 1 << 21

_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_RUNS = "runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"


# --- words ------------------------------------------------------------------------------------


def _words(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in lists of bounded length."""
    start = 0
    while len(text) - start > PIECE:
        space = _SPACE.search(text, start + PIECE)
        end = space.start() if space else len(text)
        yield text[start:end].split()
        start = end
    yield text[start:].split()


class _Numbers(dict):
    """A number for each word, from 0 in the order of their appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _numbered(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words of all texts, and where each text begins among them, with the end."""
    number = _Numbers().__getitem__
    parts, bounds, n = [], [0], 0
    for text in texts:
        for words in _words(text):
            parts.append(np.fromiter(map(number, words), np.int64, len(words)))
            n += len(words)
        bounds.append(n)
    return np.concatenate(parts) if parts else np.empty(0, np.int64), np.array(bounds)


# --- where runs can be ------------------------------------------------------------------------


def _repeated(words: np.ndarray, text: np.ndarray, window: int) -> np.ndarray:
    """Which words lie in a stretch of ``window`` words (a power of two) found twice in their text.

    A hash of each window decides, so that some more words may be marked, and none less.
    """
    marked = np.zeros(len(words) + 1, np.int64)
    if len(words) < window:
        return marked[:-1] > 0
    spread = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        h = (words.astype(np.uint64) + np.uint64(1)) * spread
        h ^= h >> np.uint64(29)
        k = 1
        while k < window:
            h = h[:-k] * np.uint64(0xBF58476D1CE4E5B9 + 2 * k) + h[k:]
            h ^= h >> np.uint64(31)
            k *= 2
        h ^= text[:len(h)].astype(np.uint64) * spread
    inside = np.flatnonzero(text[:len(h)] == text[window - 1:])
    h = h[inside]
    ordered = np.sort(h)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if len(twice):
        at = np.minimum(np.searchsorted(twice, h), len(twice) - 1)
        starts = inside[twice[at] == h]
        np.add.at(marked, starts, 1)
        np.add.at(marked, starts + window, -1)
    return np.cumsum(marked[:-1]) > 0


# --- enhanced suffix array --------------------------------------------------------------------


def _dense(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the values, and each one's rank among the distinct ones."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    rank = np.empty(len(values), np.int32)
    rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
    return order, rank


class SuffixArray:
    """Suffixes of a sequence of numbers in order, by prefix doubling.

    ``levels[k]`` ranks suffixes by their first 2 ** k numbers and has -1 behind the end, so that any
    two places are compared over any length by two looks at one level.
    """

    def __init__(self, symbols: np.ndarray):
        n = self.n = len(symbols)
        self.sa, rank = _dense(symbols)
        self.levels = [np.append(rank, np.int32(-1))]
        step = 1
        while n and rank[self.sa[-1]] < n - 1:
            key = rank.astype(np.int64) * (n + 1)
            key[:n - step] += rank[step:].astype(np.int64) + 1
            self.sa, rank = _dense(key)
            self.levels.append(np.append(rank, np.int32(-1)))
            step *= 2
        self.isa = self.levels[-1]

    def agree(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the numbers at a and b are the same over that length (at least 1), all inside."""
        k = np.minimum(np.frexp(length)[1] - 1, len(self.levels) - 1)
        out = np.zeros(len(a), bool)
        for level in np.unique(k).tolist():
            at, rank, size = k == level, self.levels[level], 1 << level
            x, y, rest = a[at], b[at], length[at] - size
            out[at] = (rank[x] == rank[y]) & (rank[x + rest] == rank[y + rest])
        return out

    def lcp(self) -> np.ndarray:
        """Numbers that each suffix shares with the one before it in order; -1 for the first."""
        a, b = self.sa[:-1].copy(), self.sa[1:].copy()
        shared = np.zeros(max(self.n - 1, 0), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            same = self.levels[k][a] == self.levels[k][b]
            step = same.astype(np.int64) << k
            a, b, shared = a + step, b + step, shared + step
        return np.concatenate([[-1], shared])[:self.n]


def _nearest(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each place the nearest one with no larger value, and with a smaller one, before and behind."""
    values = lcp.tolist()
    n = len(values)
    before_le, before_lt, behind_le, behind_lt = [0] * n, [0] * n, [n] * n, [n] * n
    stack = [0]
    for x in range(1, n):
        value = values[x]
        top = stack[-1]
        while values[top] > value:
            behind_lt[top] = x
            if behind_le[top] == n:
                behind_le[top] = x
            stack.pop()
            top = stack[-1]
        before_le[x] = top
        if values[top] == value:
            behind_le[top] = x
            before_lt[x] = before_lt[top]
        else:
            before_lt[x] = top
        stack.append(x)
    return tuple(np.array(x, np.int64) for x in (before_le, before_lt, behind_le, behind_lt))


def _small_children(lcp: np.ndarray) -> tuple[np.ndarray, ...]:
    """``first, last, left, right, depth`` of every child but the largest of every interval.

    A child are the places first to last of the suffix array; its interval are left to right, whose
    suffixes share ``depth`` numbers. Intervals that share nothing are left out.
    """
    before_le, before_lt, behind_le, behind_lt = _nearest(lcp)
    x = np.flatnonzero(lcp >= 1)
    last = x[behind_le[x] == behind_lt[x]]
    first = np.concatenate([before_le[x], last])
    end = np.concatenate([x - 1, behind_lt[last] - 1])
    at = np.concatenate([x, last])
    left, right = before_lt[at], behind_lt[at] - 1
    size = end - first
    order = np.lexsort((size, right, left))
    same = (left[order][1:] == left[order][:-1]) & (right[order][1:] == right[order][:-1])
    small = order[:-1][same]  # all but the last, which is the largest, of each interval
    return first[small], end[small], left[small], right[small], lcp[at][small]


def _squares(array: SuffixArray) -> tuple[np.ndarray, np.ndarray]:
    """Start and half length of all branching squares, each once."""
    lcp = array.lcp()
    first, last, left, right, depth = _small_children(lcp)
    # three periods must fit, so deeper intervals can hold no run
    fits = LEAST_PERIODS * depth <= array.n
    first, last, left, right, depth = (x[fits] for x in (first, last, left, right, depth))
    sizes = last - first + 1
    lots = np.cumsum(sizes) // MEMBERS
    found = []
    for lot in np.unique(lots).tolist():
        at = np.flatnonzero(lots == lot)
        child = np.repeat(at, sizes[at])
        begin = np.cumsum(sizes[at]) - sizes[at]
        place = np.arange(len(child)) - np.repeat(begin, sizes[at]) + first[child]
        suffix, q = array.sa[place], depth[child]
        for other, start in ((suffix + q, suffix), (suffix - q, suffix - q)):
            inside = (other >= 0) & (other < array.n)
            rank = array.isa[np.where(inside, other, array.n)]
            hit = (inside & (rank >= left[child]) & (rank <= right[child])
                   & ((rank < first[child]) | (rank > last[child])))
            found.append(np.stack([start[hit], q[hit]]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    start, q = np.unique(np.concatenate(found, axis=1), axis=1)
    return start, q


def _agreeing_back(symbols: np.ndarray, at: int, q: int) -> int:
    """The first place from which on, up to ``at``, numbers q apart are the same."""
    step = 64
    while at > 0:
        low = max(0, at - step)
        differ = np.flatnonzero(symbols[low:at] != symbols[low + q:at + q])
        if len(differ):
            return low + int(differ[-1]) + 1
        at, step = low, step * 2
    return at


def runs(symbols: np.ndarray) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of all runs in a sequence of numbers, by start, then period.

    A run is a stretch with that smallest period, of at least 24 numbers and three periods, which no
    neighbour extends.
    """
    array = SuffixArray(symbols)
    start, q = _squares(array)
    end = start + 2 * q
    least = np.maximum(LEAST_WORDS, LEAST_PERIODS * q)
    fits = np.flatnonzero(end >= least)
    first = (end - least)[fits]
    long = fits[array.agree(first, first + q[fits], (least - q)[fits])] if len(fits) else fits
    long = long[np.lexsort((q[long], end[long]))]
    found: list[tuple[int, int, int]] = []
    known: list[tuple[int, int]] = []
    ending = -1
    for e, period in zip(end[long].tolist(), q[long].tolist()):
        if e != ending:
            ending, known = e, []
        if any(period % p == 0 and e - 2 * period >= s for p, s in known):
            continue  # a square of several periods of a run that ends here
        s = _agreeing_back(symbols, e - 2 * period, period)
        known.append((period, s))
        found.append((s, e - s, period))
    return sorted(found, key=lambda r: (r[0], r[2]))


def runs_of_texts(words: np.ndarray, bounds: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """The runs of each of several texts, given as one sequence of numbers and where each begins.

    Words outside any repeated stretch of 16 are in no run: one with period q has its words again q
    words on over at least 24 - q words for q up to 8, and over 2q for larger ones. The others, text by
    text, go into one suffix array. Numbers of different texts and of gaps differ, so nothing there
    agrees across them.
    """
    out: list[list[tuple[int, int, int]]] = [[] for _ in bounds[:-1]]
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    at = np.flatnonzero(_repeated(words, text, 16))
    if not len(at):
        return out
    gap = np.flatnonzero((np.diff(at) > 1) | (np.diff(text[at]) > 0)) + 1
    _, own = _dense(text[at] * (int(words.max()) + 1) + words[at])
    breaks = np.append(gap, len(at))
    symbols = np.insert(own, breaks, int(own.max()) + 1 + np.arange(len(breaks), dtype=np.int32))
    places = np.insert(at, breaks, -1)
    for start, length, period in runs(symbols):
        place = int(places[start])
        i = int(text[place])
        out[i].append((place - int(bounds[i]), length, period))
    return out


# --- texts ------------------------------------------------------------------------------------


def _kept(text: bytes, found: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    if not found:
        return b" ".join(b" ".join(words) for words in _words(text) if words)
    out, n = [], 0
    for words in _words(text):
        keep = np.ones(len(words), bool)
        for start, length, period in found:
            keep[max(start + period - n, 0):max(start + length - n, 0)] = False
        out.append(b" ".join(compress(words, keep)))
        n += len(words)
    return b" ".join(part for part in out if part)


def find_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, runs, collapsed``: every run of words of each text, and the text without repetitions.

    ``runs`` holds ``start`` (number of the first word, from 0), ``length`` and ``period`` in words, by
    start, then period; ``collapsed`` the words that no run holds after its first period. Null and
    empty texts have no run and collapse to the empty string; repeated rows and null ids give a row
    each; no row, no result; other columns are left out. Map only. Texts are worked on whole, in slices
    of 4 MB or one longer text; the suffix array takes about 200 bytes for each word that lies in a
    repeated stretch, so its text bounds what a task needs.
    """
    source = docs.select(F.col(id_column), F.col(text_column).cast("binary"))
    schema = T.StructType([source.schema[id_column], *T._parse_datatype_string(_RUNS).fields])
    spans = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
            lot = np.cumsum(lengths.astype(np.int64) + 64) // SLICE
            bounds = [0, *(np.flatnonzero(np.diff(lot)) + 1).tolist(), len(lot)]
            for a, b in zip(bounds, bounds[1:]):
                if b == a:
                    continue
                some = batch.slice(a, b - a)
                texts = [text or b"" for text in some.column(1).to_pylist()]
                found = runs_of_texts(*_numbered(texts))
                collapsed = pa.array([_kept(t, r) for t, r in zip(texts, found)], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [some.column(0),
                     pa.array([[dict(zip(("start", "length", "period"), r)) for r in x] for x in found], spans),
                     collapsed.view(pa.string())],
                    names=schema.names)

    return source.mapInArrow(run, schema)


# --- query ------------------------------------------------------------------------------------


def _with_repeats(text: Column, key: Column) -> Column:
    """The query's texts: in one of ten, by its key, the words from some place on repeat a stretch."""
    h = F.crc32(key.cast("string"))
    g = F.floor(h / 10).cast("long")

    def repeat(words: Column) -> Column:
        a = (g % F.size(words)).cast("int")
        p = (1 + F.floor((F.size(words) - a) / (3 + g % 8))).cast("int")
        return F.array_join(F.transform(words, lambda w, i: F.when(i < a, w).otherwise(
            F.get(words, a + (i - a) % p))), " ")

    stripped = F.btrim(text, F.lit(SPACES))
    chosen = (h % 10 == 0) & (F.length(stripped) > 0)
    return F.when(chosen, let(F.split(stripped, r"[\x20\x09-\x0D]+"), repeat)).otherwise(text)


def runs_query(docs: DataFrame) -> DataFrame:
    texts = docs.select("doc_id", _with_repeats(F.col("text"), F.col("doc_id")).alias("text"))
    found = find_runs(texts)
    each = found.schema["runs"].dataType.elementType.simpleString()
    best = F.aggregate("runs", F.lit(None).cast(each), lambda best, r: F.when(
        best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    whole = found.withColumn("best", best)
    return whole.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        *(F.col("best")[c].alias(c) for c in ("start", "length", "period")),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"))
