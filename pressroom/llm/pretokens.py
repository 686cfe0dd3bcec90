"""Splitting text into pre-tokens, and remembering what each of them encodes to."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import cache
from itertools import batched, filterfalse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: The split pattern of the public byte-level vocabularies, as their library gives it.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# The same split for texts of Latin letters and general punctuation, in the faster `re` module.
# Classes are written out, since `re` has no \p and its \s differs.
_L = "A-Za-zªµºÀ-ÖØ-öø-ˁ"
_N = "0-9²³¹¼-¾"
_S = "\t-\r \u0085\u00a0"
_LATIN = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
_NOT_LATIN = re.compile("[^\x00-ˁ‐-‧‰-⁞]")

#: Texts longer than this are split piecewise, so that their pre-tokens are never all in memory.
LONG_TEXT = 1 << 20
#: Pre-tokens a worker remembers; then it starts anew. About 200 bytes each.
MEMO_SIZE = 300_000
#: Longer pre-tokens are encoded each time instead of being remembered.
MEMO_LENGTH = 64


@cache
def _general(pattern: str) -> regex.Pattern:
    return regex.compile(pattern)


def pretokens(text: str, pattern: str = PATTERN) -> Iterator[list[str]]:
    """The matches of ``pattern`` in ``text``, in order, in lists of bounded length."""
    latin = pattern == PATTERN and not _NOT_LATIN.search(text)
    compiled = _LATIN if latin else _general(pattern)
    if len(text) <= LONG_TEXT:
        yield compiled.findall(text)
    else:
        for some in batched((m.group() for m in compiled.finditer(text)), LONG_TEXT // 4):
            yield list(some)


class Memo:
    """Encodes pre-tokens to bytes, those not seen of late all together.

    ``encode`` maps a list of distinct pre-tokens to as many bytes objects. A pre-token is remembered
    from its second sighting on, since most are never seen again; those of at most ``at_once`` letters
    are from their first, which pays where encoding costs more than the room. Such a memo, when full,
    becomes the old one of a new memo that takes over what is met again.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], at_once: int = 0):
        self.encode = encode
        self.at_once = at_once
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.seen = bytearray(1 << 22)

    def joined(self, texts: list[list[list[str]]]) -> list[bytes]:
        """For each text, given as its lists of pre-tokens, the bytes of all its pre-tokens."""
        if len(self.known) > MEMO_SIZE:
            self.old = self.known if self.at_once else {}
            self.known = {}
            self.seen = bytearray(1 << 22)
        known, seen, old = self.known, self.seen, self.old
        every = set().union(*(words for text in texts for words in text))
        new = list(filterfalse(known.__contains__, every))  # in any order: each is encoded alone
        if old:
            known.update((word, old[word]) for word in new if word in old)
            new = [word for word in new if word not in old]
        known.update(zip(new, self.encode(new) if new else ()))
        get = known.__getitem__
        out = [b"".join(b"".join(map(get, words)) for words in text) for text in texts]
        for word in new:
            if len(word) <= self.at_once:
                continue
            place = hash(word) & 0x3FFFFF
            if len(word) > MEMO_LENGTH or not seen[place]:
                seen[place] = 1
                del known[word]
        return out


def in_slices(batch: pa.RecordBatch, column: int, size: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """A batch in slices whose texts have about so many bytes, each with its texts; null is empty."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(lengths.astype(np.int64) + 64) // size
    bounds = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
    for a, b in zip(bounds, bounds[1:]):
        if b > a:
            some = batch.slice(a, b - a)
            yield some, [text or "" for text in some.column(column).to_pylist()]
