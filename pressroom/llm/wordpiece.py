"""How many word pieces greedy longest match gives, without building the pieces.

The vocabulary is a trie with failure links. Where a word can't go on, the link leads to the place of
what is left after taking the longest pieces, and the link's stored number says how many that were.
Each byte is read once; the count is the sum of the numbers on the way.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import filterfalse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressroom.llm.bpe import Ranks
from pressroom.llm.common import WORD
from pressroom.llm.pretokens import LONG_TEXT, MEMO_LENGTH, MEMO_SIZE

_WORD = re.compile(WORD)


class Automaton:
    """Trie of first pieces at node 0 and of later pieces at node 1, with failure links and counts."""

    def __init__(self, first: Iterable[bytes], later: Iterable[bytes]):
        self.step: list[dict[int, int]] = [{}, {}]
        self.ends: list[bool] = [False, False]
        for root, pieces in ((0, first), (1, later)):
            for piece in pieces:
                node = root
                for byte in piece:
                    node = self.step[node].setdefault(byte, len(self.step))
                    if node == len(self.step):
                        self.step.append({})
                        self.ends.append(False)
                self.ends[node] |= node != root
        self.link = [-1] * len(self.step)
        self.popped = [0] * len(self.step)
        level = [0, 1]
        while level:
            below = []
            for node in level:
                for byte, child in self.step[node].items():
                    below.append(child)
                    if self.ends[child]:
                        self.link[child], self.popped[child] = 1, 1
                        continue
                    at, taken = self.link[node], self.popped[node]
                    while at >= 0 and byte not in self.step[at]:
                        taken += self.popped[at]
                        at = self.link[at]
                    if at >= 0:
                        self.link[child], self.popped[child] = self.step[at][byte], taken
            level = below

    def count(self, word: bytes) -> int:
        """Pieces of a word; 1, for the unknown piece, if greedy matching can't cover it; 0 of nothing."""
        step, link, popped = self.step, self.link, self.popped
        node = total = 0
        for byte in word:
            while byte not in step[node]:
                total += popped[node]
                node = link[node]
                if node < 0:
                    return 1
            node = step[node][byte]
        while node > 1:
            total += popped[node]
            node = link[node]
            if node < 0:
                return 1
        return total


@cache
def from_ranks(path: str) -> Automaton:
    """Pieces from a byte-level rank file.

    Tokens that begin with a space are first pieces, without it; the others are later pieces, and
    single bytes are both, so that no word is unknown.
    """
    tokens = [t for t in Ranks(path).rank if len(t) > 1 or t != b" "]
    return Automaton(
        [t[1:] for t in tokens if t[:1] == b" "] + [t for t in tokens if len(t) == 1],
        [t for t in tokens if t[:1] != b" "])


def word_counts(path: str):
    """A column function: a text's words and their pieces, as an array of two longs.

    Words are separated by ASCII white space. A null or empty text has none.
    """

    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        automaton = from_ranks(path)
        known: dict[str, int] = {}
        for batch in batches:
            out = np.zeros((len(batch), 2), np.int64)
            for row, text in enumerate(batch):
                for words in _words(text.as_py() or ""):
                    if len(known) > MEMO_SIZE:
                        known.clear()
                    short = []
                    for word in filterfalse(known.__contains__, set(words)):
                        known[word] = automaton.count(word.encode())
                        if len(word) > MEMO_LENGTH:
                            short.append(word)
                    out[row] += len(words), sum(map(known.__getitem__, words))
                    for word in short:
                        del known[word]
            yield pa.FixedSizeListArray.from_arrays(pa.array(out.reshape(-1)), 2).cast(pa.list_(pa.int64()))

    return F.arrow_udf(count, "array<long>")


def _words(text: str) -> Iterator[list[str]]:
    """A text's words, in lists of bounded length."""
    if len(text) <= LONG_TEXT:
        yield _WORD.findall(text)
        return
    held: list[str] = []
    for found in _WORD.finditer(text):
        held.append(found.group())
        if len(held) == LONG_TEXT // 4:
            yield held
            held = []
    yield held


def with_piece_counts(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words`` and ``n_pieces``; columns of those names are replaced.

    Every row gets both: nulls and empty texts zeros, repeated rows the same numbers, words of any
    length a count. An empty table stays one.
    """
    counted = docs.withColumn("n_words", word_counts(path)(F.col(text)))
    return counted.withColumn("n_pieces", F.col("n_words")[1]).withColumn("n_words", F.col("n_words")[0])


def piece_query(docs: DataFrame, path: str) -> DataFrame:
    return with_piece_counts(docs.select("doc_id", "text"), path).drop("text")
