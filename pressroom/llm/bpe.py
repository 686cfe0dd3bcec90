"""Byte-level BPE over the ranks of a public vocabulary: text to ids and back.

Each pre-token is a row of bytes. A segment tree over the byte positions keeps the pair of lowest
rank, the leftmost among equals; a merge removes one position and updates three leaves of the tree,
each in logarithmic time. Short pre-tokens are merged many at once, as lanes of arrays that step
through their merges together; long ones one by one.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressroom.llm.pretokens import PATTERN, Memo, in_slices, pretokens

#: Pre-tokens of more bytes are merged one by one.
LANE_BYTES = 256
#: Rows decoded together.
DECODE_ROWS = 256
#: Stands above every rank.
_NONE = 1 << 20


class Ranks:
    """A vocabulary read from a rank file: token bytes, and the rank of every mergeable pair."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            pairs = [line.split() for line in file if line.strip()]
        self.rank = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.token = [b""] * (max(self.rank.values()) + 1)
        for token, rank in self.rank.items():
            self.token[rank] = token
        self.byte = np.array([self.rank[bytes([b])] for b in range(256)], np.int64)
        merged = {}
        for token, rank in self.rank.items():
            for cut in range(1, len(token)):
                left, right = self.rank.get(token[:cut]), self.rank.get(token[cut:])
                if left is not None and right is not None:
                    merged[left << 20 | right] = rank
        self.pair = merged
        self.keys = np.array(sorted(merged), np.int64)
        self.values = np.array([merged[k] for k in self.keys.tolist()], np.int64)

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids; ``_NONE`` where they don't merge or one is absent (-1)."""
        keys = left << 20 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        found = (self.keys[at] == keys) & (left >= 0) & (right >= 0)
        return np.where(found, self.values[at], _NONE)


def merge_one(ranks: Ranks, data: bytes) -> list[int]:
    """Ids of one pre-token, by a segment tree in plain lists."""
    n = len(data)
    ids = ranks.byte[np.frombuffer(data, np.uint8)].tolist()
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    size = 1 << max(n - 1, 1).bit_length()
    shift = size.bit_length()
    none = _NONE << shift
    tree = [none] * (2 * size)
    pair = ranks.pair

    def key(i: int) -> int:
        j = after[i]
        if j >= n:
            return none
        rank = pair.get(ids[i] << 20 | ids[j])
        return none if rank is None else rank << shift | i

    for i in range(n - 1):
        tree[size + i] = key(i)
    for node in range(size - 1, 0, -1):
        a, b = tree[2 * node], tree[2 * node + 1]
        tree[node] = a if a < b else b

    def put(i: int, value: int) -> None:
        node = size + i
        tree[node] = value
        while node > 1:
            node >>= 1
            a, b = tree[2 * node], tree[2 * node + 1]
            least = a if a < b else b
            if tree[node] == least:
                return
            tree[node] = least

    while tree[1] < none:
        rank, i = tree[1] >> shift, tree[1] & ((1 << shift) - 1)
        j = after[i]
        ids[i] = rank
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        ids[j] = -1
        put(j, none)
        put(i, key(i))
        if before[i] >= 0:
            put(before[i], key(before[i]))
    return [x for x in ids if x >= 0]


def merge_lanes(ranks: Ranks, words: list[bytes]) -> list[bytes]:
    """Little-endian ids of each pre-token; all of them take their next merge at the same time."""
    lengths = np.array([len(w) for w in words], np.int64)
    count, size = len(words), 1 << max(int(lengths.max()) - 1, 1).bit_length()
    shift = size.bit_length()
    none = _NONE << shift
    flat = np.frombuffer(b"".join(words), np.uint8)
    row = np.repeat(np.arange(count), lengths)
    column = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    width = size + 2  # ids and links have a border on either side
    ids = np.full(count * width, -1, np.int64)
    ids[row * width + column + 1] = ranks.byte[flat]
    after = np.tile(np.minimum(np.arange(width) + 1, width - 1), count)
    before = np.tile(np.maximum(np.arange(width) - 1, 0), count)
    grid = ids.reshape(count, width)
    tree = np.full((count, 2 * size), none, np.int64)
    leaf = ranks.ranks_of(grid[:, 1:-1], grid[:, 2:])
    tree[:, size:] = np.where(leaf < _NONE, leaf << shift | np.arange(size), none)
    level = size
    while level > 1:
        tree[:, level // 2:level] = np.minimum(tree[:, level:2 * level:2], tree[:, level + 1:2 * level:2])
        level //= 2
    flat_tree = tree.reshape(-1)

    def key(lane: np.ndarray, i: np.ndarray) -> np.ndarray:
        base = lane * width
        rank = ranks.ranks_of(ids[base + i], ids[base + after[base + i]])
        return np.where(rank < _NONE, rank << shift | (i - 1), none)

    def put(lane: np.ndarray, i: np.ndarray, value: np.ndarray) -> None:
        base, node = lane * (2 * size), size + i - 1
        flat_tree[base + node] = value
        while node[0] > 1:
            node = node >> 1
            left = base + 2 * node
            flat_tree[base + node] = np.minimum(flat_tree[left], flat_tree[left + 1])

    lane = np.flatnonzero(tree[:, 1] < none)
    while len(lane):
        root = flat_tree[lane * (2 * size) + 1]
        i = (root & ((1 << shift) - 1)) + 1
        base = lane * width
        j = after[base + i]
        k = after[base + j]
        ids[base + i] = root >> shift
        ids[base + j] = -1
        after[base + i] = k
        before[base + k] = i
        put(lane, j, np.full(len(lane), none))
        put(lane, i, key(lane, i))
        h = before[base + i]
        some = h > 0
        if some.any():
            put(lane[some], h[some], key(lane[some], h[some]))
        lane = lane[flat_tree[lane * (2 * size) + 1] < none]
    kept = ids.reshape(count, width) >= 0
    values = ids.reshape(count, width)[kept].astype("<u4").tobytes()
    ends = np.cumsum(kept.sum(axis=1)) * 4
    return [values[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]


def encode_words(ranks: Ranks, words: list[str]) -> list[bytes]:
    """Little-endian ids of each pre-token."""
    data = [w.encode() for w in words]
    out: list[bytes] = [b""] * len(data)
    lanes: dict[int, list[int]] = {}
    for i, word in enumerate(data):
        whole = ranks.rank.get(word)
        if whole is not None:
            out[i] = whole.to_bytes(4, "little")
        elif len(word) > LANE_BYTES:
            out[i] = np.array(merge_one(ranks, word), "<u4").tobytes()
        else:
            lanes.setdefault((len(word) - 1).bit_length(), []).append(i)
    for at in lanes.values():
        for start in range(0, len(at), 8192):
            some = at[start:start + 8192]
            for i, value in zip(some, merge_lanes(ranks, [data[i] for i in some])):
                out[i] = value
    return out


@cache
def _ranks(path: str) -> Ranks:
    return Ranks(path)


@cache
def _memo(path: str) -> Memo:
    ranks = _ranks(path)
    return Memo(lambda words: encode_words(ranks, words))


def encode_documents(
    docs: DataFrame, path: str, pattern: str = PATTERN, text: str = "text", ids: str = "token_ids",
    keep_text: bool = True,
) -> DataFrame:
    """``docs`` with the ids of each whole text, an array of int; a column of that name is replaced.

    A null or empty text has no ids. Pre-tokens are the matches of ``pattern``; nothing is read as a
    special token. Any length of text, and any length of one match, is encoded whole; repeated rows
    alike; other columns are carried. Rows leave in small slices, so that no large batch is held.
    """
    source = docs.drop(ids)
    kept = [c for c in source.columns if keep_text or c != text]
    at = source.columns.index(text)
    schema = T.StructType([*(source.schema[c] for c in kept), T.StructField(ids, T.ArrayType(T.IntegerType()))])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _memo(path)
        for batch in batches:
            for some, texts in in_slices(batch, at):
                found = memo.joined([list(pretokens(t, pattern)) for t in texts])
                offsets = np.zeros(len(found) + 1, np.int32)
                np.cumsum([len(x) // 4 for x in found], out=offsets[1:])
                values = pa.array(np.frombuffer(b"".join(found), "<i4"), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*(some.column(c) for c in kept), pa.ListArray.from_arrays(pa.array(offsets), values)],
                    names=schema.names)

    return source.mapInArrow(encode, schema)


def decode_documents(
    coded: DataFrame, path: str, ids: str = "token_ids", out: str = "decoded", keep_ids: bool = True
) -> DataFrame:
    """``coded`` with the bytes its ids stand for. Null gives null, no ids give no bytes."""
    source = coded.drop(out)
    kept = [c for c in source.columns if keep_ids or c != ids]
    at = source.columns.index(ids)
    schema = T.StructType([*(source.schema[c] for c in kept), T.StructField(out, T.BinaryType())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = _ranks(path).token
        for batch in batches:
            for first in range(0, batch.num_rows, DECODE_ROWS):
                some = batch.slice(first, DECODE_ROWS)
                column = some.column(at)
                bounds, values = column.offsets.to_numpy(), column.values
                data = [
                    b"".join(map(token.__getitem__, values[a:b].to_pylist())) if there else None
                    for a, b, there in zip(bounds, bounds[1:], column.is_valid().to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [*(some.column(c) for c in kept), pa.array(data, pa.binary())], names=schema.names)

    return source.mapInArrow(decode, schema)


def bpe_query(docs: DataFrame, path: str) -> DataFrame:
    coded = encode_documents(docs.select("doc_id", "text"), path, keep_text=False)
    digests = F.sha2(F.concat_ws(" ", F.col("token_ids").cast("array<string>")).cast("binary"), 256)
    back = decode_documents(
        coded.withColumns({"n_tokens": F.size("token_ids").cast("long"), "ids_sha256": digests}), path,
        keep_ids=False)
    return back.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
