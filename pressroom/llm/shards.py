"""Tokens dealt to shards by word, and per-document sums dealt back.

A count-based language model needs everything about a word in one place, and a document's score needs
all of its words. Tasks therefore cut what they read into chunks of documents and send each shard one
compressed block per chunk: words, their contexts and the documents they stand in, a few bytes a
token. A shard answers with one block of sums per chunk. Words frequent enough to fill a shard are dealt
by word and context over all shards, so no shard holds more than its share.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import filterfalse

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from pressroom.llm.pretokens import MEMO_SIZE, in_slices

#: Bits of the hash of a word before: a word shares its context with odds of the vocabulary's size over 2^48.
CONTEXT_BITS = 48
#: Tokens of a chunk, about, and its documents at most.
CHUNK_TOKENS, CHUNK_DOCUMENTS = 1 << 21, 1 << 16
#: Characters of text for each shard.
SHARD_CHARACTERS = 16_000_000
#: One document in so many nominates hot words: they are an arrangement only and change no result.
NOMINATING = 64


def _hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word)


hash_of = _hash


#: The token after the last word of a text. No word is a line break.
END = _hash(b"\n")


def contexts_of(before: np.ndarray) -> np.ndarray:
    """The contexts that words before make, by their hashes."""
    return before >> np.uint64(64 - CONTEXT_BITS)


def words_of(text: str) -> list[bytes]:
    """Runs of other than ASCII white space, A-Z lower-cased."""
    return text.encode().lower().split()


@dataclass(frozen=True)
class Layout:
    """Number of shards, and the sorted hashes of hot words."""

    shards: int
    hot: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))

    def hot_index(self, words: np.ndarray) -> np.ndarray:
        """Place of each word among the hot ones, or -1."""
        if not len(self.hot):
            return np.full(len(words), -1)
        at = np.minimum(np.searchsorted(self.hot, words), len(self.hot) - 1)
        return np.where(self.hot[at] == words, at, -1)

    def shard_of(self, words: np.ndarray, contexts: np.ndarray) -> np.ndarray:
        mixed = (words ^ (contexts.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        key = np.where(self.hot_index(words) >= 0, mixed, words)
        return ((key >> np.uint64(32)) * np.uint64(self.shards) >> np.uint64(32)).astype(np.int32)


def layout_for(
    docs: DataFrame, text: str = "text", shards_for: Callable[[int], int] = lambda total: -(-total // SHARD_CHARACTERS),
) -> Layout:
    """Shards for the size of the corpus, given its characters, and hot words as some documents suggest them."""
    total = docs.agg(F.coalesce(F.sum(F.length(text)), F.lit(0))).first()[0]
    shards = max(1, shards_for(total))
    some = docs.where(F.pmod(F.xxhash64(text), F.lit(NOMINATING)) == 0)
    words = some.select(F.explode(F.split(F.lower(text), r"[\x20\x09-\x0D]+")).alias("word")).where("word <> ''")
    counts = words.groupBy("word").agg(F.count("*").alias("n"))
    n = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = counts.where(F.col("n") > n / (8 * shards)).select("word").toArrow()["word"].to_pylist()  # 8 a shard
    hashes = [_hash(w.encode()) for w in hot] + [END]
    return Layout(int(shards), np.unique(np.array(hashes, np.uint64)))


def packed(*arrays: np.ndarray) -> bytes:
    """The arrays compressed, their bytes by significance, since the higher ones are often alike."""
    sizes = np.array([a.nbytes for a in arrays], np.int64)
    planes = (np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T.tobytes() for a in arrays)
    return zstandard.compress(sizes.tobytes() + b"".join(planes), 1)


def unpacked(data: bytes, *kinds: str) -> list[np.ndarray]:
    raw = zstandard.decompress(data)
    at, out = 8 * len(kinds), []
    for size, kind in zip(np.frombuffer(raw[:at], np.int64).tolist(), kinds):
        width = np.dtype(kind).itemsize
        planes = np.frombuffer(raw, np.uint8, size, at).reshape(width, -1)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += size
    return out


def gaps(ascending: np.ndarray) -> np.ndarray:
    """Differences, from which ``np.cumsum`` of the same type gives the array again."""
    return np.diff(ascending, prepend=ascending.dtype.type(0))


def packed_tokens(words: np.ndarray, counts: np.ndarray, contexts: np.ndarray, docs: np.ndarray) -> bytes:
    """A block: sorted distinct words, their tokens' number, sorted distinct contexts, and each token's
    place among those and document."""
    known, place = np.unique(contexts, return_inverse=True)
    return packed(gaps(words), counts, gaps(known), place.astype(np.uint32), gaps(docs))


def unpacked_tokens(data: bytes, words: str = "u8", contexts: str = "u8") -> tuple[np.ndarray, ...]:
    """Words, counts, contexts, places and documents of a block."""
    w, counts, known, place, docs = unpacked(data, words, "u4", contexts, "u4", "u2")
    return (np.cumsum(w, dtype=words), counts, np.cumsum(known, dtype=contexts), place, np.cumsum(docs, dtype=np.uint16))


#: Columns of the rows between tasks. A block goes to a shard; a row with a document goes wherever its chunk goes.
SCHEMA = "shard int, chunk long, train boolean, block binary, doc int, id {id}, n_tokens long"
COLUMNS = ("shard", "chunk", "train", "block", "doc", "id", "n_tokens")


class _Chunk:
    """Documents gathered for one chunk."""

    def __init__(self, train: bool):
        self.train = train
        self.words: list[np.ndarray] = []
        self.ids: list[pa.Array] = []
        self.sizes: list[int] = []
        self.tokens = 0

    def blocks(self, layout: Layout, numbers: Callable[[np.ndarray], np.ndarray], pack: Callable[..., bytes]) -> Iterator[tuple[int, bytes]]:
        words = np.concatenate(self.words)
        before = np.empty_like(words)
        before[0], before[1:] = END, words[:-1]  # a text follows the end of another
        contexts = contexts_of(before)
        docs = np.repeat(np.arange(len(self.sizes), dtype=np.uint16), self.sizes)
        shard = layout.shard_of(words, contexts)
        contexts = numbers(contexts)
        order = np.argsort(words, kind="stable")
        order = order[np.argsort(shard[order].astype(np.uint16) if layout.shards < 1 << 16 else shard[order], kind="stable")]
        words, contexts, docs, shard = words[order], contexts[order], docs[order], shard[order]
        cuts = np.flatnonzero(np.diff(shard)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(words)]):
            first = np.flatnonzero(np.concatenate([[True], words[a + 1:b] != words[a:b - 1]]))
            counts = np.diff(np.concatenate([first, [b - a]])).astype(np.uint32)
            yield int(shard[a]), pack(words[a:b][first], counts, contexts[a:b], docs[a:b])


def token_blocks(
    docs: DataFrame, layout: Layout, numbers: Callable[[np.ndarray], np.ndarray] = lambda contexts: contexts,
    pack: Callable[..., bytes] = packed_tokens,
) -> DataFrame:
    """Rows of ``SCHEMA`` for documents ``id, text, train``.

    ``numbers`` gives what stands for the contexts in a block, ``pack`` its bytes.
    """
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        known: dict[bytes, int] = {}
        open_: dict[bool, _Chunk] = {}

        def sent(chunk: _Chunk) -> Iterator[pa.RecordBatch]:
            nonlocal number
            for shard, block in chunk.blocks(layout, numbers, pack):
                yield rows([shard], [number], [chunk.train], [block], [None], pa.nulls(1, kind_of_id), [None])
            n = len(chunk.sizes)
            task, place = divmod(number, 1 << 24)
            yield rows(
                [(task + place) % layout.shards] * n, [number] * n, [chunk.train] * n, [None] * n,
                list(range(n)), pa.concat_arrays(chunk.ids), chunk.sizes)
            number += 1

        def rows(shard, chunk, train, block, doc, ids, sizes) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(shard, pa.int32()), pa.array(chunk, pa.int64()), pa.array(train), pa.array(block, pa.binary()),
                 pa.array(doc, pa.int32()), ids, pa.array(sizes, pa.int64())],
                names=["shard", "chunk", "train", "block", "doc", "id", "n_tokens"])

        kind_of_id = None
        for batch in batches:
            kind_of_id = batch.column(0).type
            for some, texts in in_slices(batch, 1):
                flags = some.column(2).to_pylist()
                for i, (text, flag) in enumerate(zip(texts, flags)):
                    words = words_of(text)
                    if len(known) > MEMO_SIZE:
                        known.clear()
                    for word in filterfalse(known.__contains__, set(words)):
                        known[word] = _hash(word)
                    words.append(b"\n")
                    known[b"\n"] = END
                    chunk = open_.setdefault(bool(flag), _Chunk(bool(flag)))
                    chunk.words.append(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)))
                    chunk.ids.append(some.column(0).slice(i, 1))
                    chunk.sizes.append(len(words))
                    chunk.tokens += len(words)
                    if chunk.tokens >= CHUNK_TOKENS or len(chunk.sizes) == CHUNK_DOCUMENTS:
                        yield from sent(open_.pop(chunk.train))
        for chunk in open_.values():
            yield from sent(chunk)

    return docs.select("id", "text", "train").mapInArrow(run, SCHEMA.format(id=kind))


def by_key(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[list[dict], pa.Schema]]:
    """The rows of a task sorted by ``key``, one key's at a time, and their schema."""
    held: list[dict] = []
    schema = None
    for batch in batches:
        schema = batch.schema
        for row in batch.to_pylist():
            if held and row[key] != held[-1][key]:
                yield held, schema
                held = []
            held.append(row)
    if held:
        yield held, schema


def record(rows: list[dict], names: tuple[str, ...], schema: pa.Schema) -> pa.RecordBatch:
    """Rows as a batch of the named columns, typed as in ``schema``; a column not in it holds text."""
    types = [schema.field(c).type if c in schema.names else pa.string() for c in names]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[c] for r in rows], t) for c, t in zip(names, types)], names=list(names))


def summed(parts: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """``id, train, n_tokens`` and the columns' sums, from the shards' rows.

    ``parts`` has documents' rows as they came, and rows whose ``block`` packs documents and one double
    array per column. A task adds the blocks of one chunk at a time.
    """
    kind = parts.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, schema in by_key(batches, "chunk"):
            docs = sorted((r for r in rows if r["doc"] is not None), key=lambda r: r["doc"])
            sums = np.zeros((len(columns), len(docs)))
            for row in rows:
                if row["block"] is not None:
                    at, *values = unpacked(row["block"], "u2", *["f8"] * len(columns))
                    for own, value in zip(sums, values):
                        own[at] += value
            known = record(docs, ("id", "train", "n_tokens"), schema)
            yield pa.RecordBatch.from_arrays(
                [*known.columns, *map(pa.array, sums)], names=["id", "train", "n_tokens", *columns])

    kinds = ", ".join(f"{c} double" for c in columns)
    return (parts.select("chunk", "train", "block", "doc", "id", "n_tokens")
            .repartition("chunk").sortWithinPartitions("chunk")
            .mapInArrow(run, f"id {kind}, train boolean, n_tokens long, {kinds}"))
