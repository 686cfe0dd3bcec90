"""Best-fit packing of items into bins, and documents cut into token pieces for it.

Hierarchical residual packing: every task packs what it reads by best fit and is done with bins
that are nearly full. The others become items themselves, as long as what they hold, and are packed
again with those of other tasks, in fewer and fewer tasks. An item's place is the sum of the places
on its way up. Items are dealt out before the first round, so that a task sees long and short ones
however they were ordered.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import cache
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.taskcontext import TaskContext

from pressroom.llm.pretokens import Memo, in_slices, pretokens
from pressroom.session import write_and_read

#: Ids a sequence holds.
CAPACITY = 2048
#: A bin with no more room than this part of it is nearly full and is not packed again.
SLACK = 1 / 256
#: Pre-tokens encoded as one text; letters up to which a pre-token is remembered when first seen.
JOINED, AT_ONCE = 256, 16
#: Rows or bytes that a task packs at once.
CHUNK_ROWS, CHUNK_BYTES = 1 << 17, 64 << 20
#: Tasks whose open bins the next round packs together.
FAN_IN = 8
#: Open bins that one task of a later round takes at most, so that no round needs one large task.
ROUND_ITEMS = 200_000
#: Part of the open bins that a further round of as many groups must close or join to be followed by another.
LEAST_GAIN = 1 / 1000


# --- tokens -----------------------------------------------------------------------------------


@cache
def _memo(path: str) -> tuple[Memo, object]:
    """The tokenizer's file read once per worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)

    def encode(words: list[str]) -> list[bytes]:
        """Those of one space and letters, digits or signs stay apart when joined, so they go in lots."""
        apart = [w[0] == " " and not w[-1].isspace() for w in words]
        joined = list(compress(words, apart))
        texts = ["".join(joined[k:k + JOINED]) for k in range(0, len(joined), JOINED)]
        parts: list[bytes] = []
        for found in tokenizer.encode_batch(texts, add_special_tokens=False):
            data = np.array(found.ids, "<u4").tobytes()
            bounds = (4 * np.flatnonzero(np.diff(found.word_ids)) + 4).tolist()
            parts += [data[a:b] for a, b in zip([0, *bounds], [*bounds, len(data)])]
        alone = tokenizer.encode_batch_fast([w for w, a in zip(words, apart) if not a], add_special_tokens=False)
        others = iter([np.array(x.ids, "<u4").tobytes() for x in alone])
        lots = iter(parts)
        return [next(lots) if a else next(others) for a in apart]

    return Memo(encode, AT_ONCE), tokenizer


def _token_bytes(path: str, texts: list[str]) -> list[bytes]:
    """Little-endian ids of each text, as the tokenizer gives them.

    Byte-level merges stay within pre-tokens, so each distinct pre-token is encoded once. A text that
    spells out a special token goes to the tokenizer whole, which looks for those before it splits.
    """
    memo, tokenizer = _memo(path)
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    whole = [i for i, text in enumerate(texts) if any(s in text for s in special)]
    out = memo.joined([[] if i in whole else list(pretokens(t)) for i, t in enumerate(texts)])
    for i in whole:
        out[i] = np.array(tokenizer.encode(texts[i], add_special_tokens=False).ids, "<u4").tobytes()
    return out


def cut_documents(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Token pieces of at most ``capacity`` ids: ``id, piece, start, length, ids`` and no other column.

    A document's ids are the tokenizer's, then ``end_id``; a null or empty text has that one id. Only
    longer ones are cut; their pieces are full but for the first. ``ids`` holds little-endian unsigned
    32-bit numbers. Repeated rows and null ids give pieces like any other row; no row, no piece.
    """
    source = docs.select(F.col(id_column), F.col(text_column))
    key = source.schema[id_column]
    schema = T.StructType([
        T.StructField(id_column, key.dataType), T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType())])
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, texts in in_slices(batch, 1):
                rows, piece, start, ids = [], [], [], []
                for i, data in enumerate(_token_bytes(tokenizer, texts)):
                    data += end
                    n = len(data) // 4
                    first = n % capacity or capacity
                    bounds = [0, *range(first, n + 1, capacity)]
                    for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
                        rows.append(i)
                        piece.append(k)
                        start.append(a)
                        ids.append(data[4 * a:4 * b])
                yield pa.RecordBatch.from_arrays(
                    [some.column(0).take(pa.array(rows)), pa.array(piece, pa.int32()),
                     pa.array(start, pa.int64()), pa.array([len(x) // 4 for x in ids], pa.int64()),
                     pa.array(ids, pa.binary())],
                    names=schema.names)

    return source.mapInArrow(cut, schema)


# --- packing ----------------------------------------------------------------------------------


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of each item: longest first, each into the fullest bin that has room.

    Bins wait in a stack per amount of room; one bit per non-empty stack finds the best in a shift.
    Equal lengths go in their given order.
    """
    bins = np.empty(len(lengths), np.int64)
    offsets = np.empty(len(lengths), np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    waiting, opened = 0, 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        fitting = waiting >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            bin_ = stacks[room].pop()
            if not stacks[room]:
                waiting &= ~(1 << room)
        else:
            room, bin_ = capacity, opened
            opened += 1
        bins[i], offsets[i] = bin_, capacity - room
        left = room - length
        if left:
            stacks[left].append(bin_)
            waiting |= 1 << left
    return bins, offsets


def _first_of(bins: np.ndarray, offsets: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each item the id of the item at its bin's start."""
    first = np.empty(bins.max(initial=-1) + 1, ids.dtype)
    first[bins[offsets == 0]] = ids[offsets == 0]
    return first[bins]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The batches of a task in tables of bounded size."""
    held, rows, size = [], 0, 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        size += batch.nbytes
        if rows >= CHUNK_ROWS or size >= CHUNK_BYTES:
            yield pa.Table.from_batches(held)
            held, rows, size = [], 0, 0
    if rows:
        yield pa.Table.from_batches(held)


#: Bins are numbered within their task; the bits above are the task's.
_TASK_BITS = 36
_PLACED = "sequence_id long, offset long, sequence_fill long"


def pack(items: DataFrame, length: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """``items`` with ``sequence_id`` and ``offset``: its bin, and its place there, gapless from 0.

    Items are 1 to ``capacity`` long; a null, smaller or larger length is an error. Ids of bins are
    numbers without order. Columns of those two names (and ``sequence_fill``, used on the way) are
    replaced; all others are carried. Repeated rows are items of their own; no item, no bin. The
    result of each round is a written table, so a lost executor repeats a task and no round. Items are
    shuffled once with all their columns, so give large ones as numbers to join back.
    """
    source = items.drop("sequence_id", "offset", "sequence_fill").hint("rebalance")
    schema = T.StructType([*source.schema.fields, *T._parse_datatype_string(_PLACED).fields])
    at = source.columns.index(length)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << _TASK_BITS
        for rows in _chunks(batches):
            sizes = rows.column(at).to_numpy().astype(np.int64)
            if rows.column(at).null_count or sizes.min() < 1 or sizes.max() > capacity:
                raise ValueError(f"lengths must be 1 to {capacity}")
            bins, offsets = best_fit(sizes, capacity)
            fill = np.bincount(bins, sizes).astype(np.int64)[bins]
            for name, values in (("sequence_id", number + bins), ("offset", offsets), ("sequence_fill", fill)):
                rows = rows.append_column(name, pa.array(values))
            number += int(bins.max()) + 1
            yield from rows.to_batches(max_chunksize=4096)

    placed = write_and_read(source.mapInArrow(local, schema), "packed")
    moves = _merge(
        placed.where((F.col("offset") == 0) & (F.col("sequence_fill") < capacity * (1 - SLACK)))
        .select(F.col("sequence_id").alias("item"), F.col("sequence_fill").alias("fill")), capacity)
    if moves is None:
        return placed.drop("sequence_fill")
    moved = moves.select(F.col("item").alias("_item"), F.col("bin").alias("_bin"), F.col("at").alias("_at"))
    joined = placed.join(moved, placed["sequence_id"] == moved["_item"], "left")
    return joined.select(
        *source.columns,
        F.coalesce("_bin", "sequence_id").alias("sequence_id"),
        (F.col("offset") + F.coalesce("_at", F.lit(0).cast("long"))).alias("offset"))


def _merge(opened: DataFrame, capacity: int) -> DataFrame | None:
    """Rounds over the open bins ``item, fill``: where each ends, as ``item, bin, at``.

    Each round has an eighth of the groups of the one before, but never more than ``ROUND_ITEMS``
    open bins in a group. The last round has one group; where that can't be, groups are drawn anew
    until a round closes or joins less than a ``LEAST_GAIN`` part of the open bins.
    """

    def repack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if held:
            rows = pa.Table.from_batches(held).combine_chunks().sort_by("item")
            ids = rows.column("item").to_numpy()
            sizes = rows.column("fill").to_numpy()
            bins, offsets = best_fit(sizes, capacity)
            fill = np.bincount(bins, sizes).astype(np.int64)[bins]
            yield from pa.table(
                {"item": ids, "bin": _first_of(bins, offsets, ids), "at": offsets, "fill": fill}
            ).to_batches(max_chunksize=65536)

    moves, number, n = None, 0, opened.count()
    groups = opened.select(F.shiftright("item", _TASK_BITS)).distinct().count()
    while n > 1:
        number += 1
        before, groups = groups, max(-(-groups // FAN_IN), -(-n // ROUND_ITEMS))
        group = F.pmod(F.xxhash64(F.col("item"), F.lit(number)), F.lit(groups)).alias("group")
        round_ = write_and_read(
            opened.select("item", "fill", group).repartition(groups, "group").select("item", "fill")
            .mapInArrow(repack, "item long, bin long, at long, fill long"), "round")
        if moves is None:
            moves = round_.select("item", "bin", "at")
        else:
            later = round_.select(
                F.col("item").alias("i2"), F.col("bin").alias("b2"), F.col("at").alias("a2"))
            moves = moves.join(later, moves["bin"] == later["i2"], "left").select(
                "item", F.coalesce("b2", "bin").alias("bin"),
                (F.col("at") + F.coalesce("a2", F.lit(0).cast("long"))).alias("at"))
        if groups == 1:
            break
        opened = round_.where((F.col("at") == 0) & (F.col("fill") < capacity * (1 - SLACK))).select(
            F.col("bin").alias("item"), "fill")
        was, n = n, opened.count()
        if groups >= before and n > was * (1 - LEAST_GAIN):
            break
    return moves


def packing_query(docs: DataFrame, tokenizer: str) -> DataFrame:
    pieces = cut_documents(docs, tokenizer)
    return pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))
