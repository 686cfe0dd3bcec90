"""Set-similarity join of texts on word shingles, by chosen paths.

A text is its set of five-word shingles. The set is embedded in as many min-hashes; a run picks a few
of them at random and puts texts that agree on one into the same bucket. A bucket that is still large
is relieved of the texts like one of its own, which are tied to that one, and is split again on min-hashes
picked for it alone; a small one is compared by brute force. A pair of the
wanted similarity meets with a fixed probability per run, and runs are repeated until the recall
asked for. Buckets only name candidates: connected candidates then meet whole and their sets are
compared exactly, in blocks, so every link inside them is found and none is guessed.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import filterfalse

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressroom.llm.common import WORD
from pressroom.llm.links import compare, components
from pressroom.llm.pretokens import MEMO_SIZE, in_slices
from pressroom.session import write_and_read

#: Words of a shingle. A text of fewer words is one shingle.
SHINGLE = 5
#: Least Jaccard similarity of a link, as a fraction.
SIMILARITY = (4, 5)
#: Min-hashes of a set.
COORDINATES = 64
#: Buckets up to this size are compared by brute force.
BUCKET = 256
#: Times a bucket is split at most; larger ones are then compared in blocks.
DEPTH = 3
RECALL = 0.999

_WORD = re.compile(WORD)
_random = np.random.default_rng(20240229)
_POWERS = _random.integers(1, 1 << 62, SHINGLE, np.uint64) * np.uint64(2) + np.uint64(1)
_XOR = _random.integers(0, 1 << 63, COORDINATES, np.uint64)
_MULTIPLY = _random.integers(1, 1 << 62, COORDINATES, np.uint64) * np.uint64(2) + np.uint64(1)


# --- sets -------------------------------------------------------------------------------------


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: str, known: dict[str, int]) -> np.ndarray:
    """The sorted set of a text's shingles, as 64-bit hashes. ``known`` remembers words' hashes."""
    words = _WORD.findall(text)
    if len(known) > MEMO_SIZE:
        known.clear()
    for word in filterfalse(known.__contains__, set(words)):
        known[word] = xxhash.xxh64_intdigest(word)
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    if len(words) == 0:
        return hashes
    n = max(len(words) - SHINGLE + 1, 1)
    total = np.full(n, len(words) if n == 1 and len(words) < SHINGLE else SHINGLE, np.uint64)
    for k in range(min(SHINGLE, len(words))):
        total += hashes[k:k + n] * _POWERS[k]
    return np.unique(_mix(total))


def min_hashes(values: np.ndarray) -> np.ndarray:
    """The set's least value under each of the hash functions; 32 bits of it."""
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(values), 512):
        part = (values[start:start + 512, None] ^ _XOR) * _MULTIPLY
        least = np.minimum(least, part.min(axis=0))
    return (_mix(least) >> np.uint64(32)).astype(np.uint32)


def node_of(values: np.ndarray) -> int:
    """One number for equal sets."""
    return xxhash.xxh3_64_intdigest(values.tobytes()) - (1 << 63)


def _signatures(texts: DataFrame) -> DataFrame:
    """``id, node, mins, sketch`` of ``id, text``; no node for a text without a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for batch in batches:
            for some, slice_texts in in_slices(batch, 1):
                nodes, mins, sketches = [], [], []
                for text in slice_texts:
                    values = shingles(text, known)
                    if len(values):
                        least = min_hashes(values)
                        low = (least & 15).astype(np.uint8)
                        nodes.append(node_of(values))
                        mins.append(least.view(np.int32))
                        sketches.append((low[::2] << 4 | low[1::2]).tobytes())
                    else:
                        nodes.append(None)
                        mins.append(None)
                        sketches.append(None)
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(nodes, pa.int64()), pa.array(mins, pa.list_(pa.int32())),
                     pa.array(sketches, pa.binary())], names=["id", "node", "mins", "sketch"])

    kind = texts.schema["id"].dataType.simpleString()
    return texts.mapInArrow(run, f"id {kind}, node long, mins array<int>, sketch binary")


# --- paths ------------------------------------------------------------------------------------


def runs_for(recall: float = RECALL) -> int:
    """Runs until a pair of the least similarity is found with that probability at the last depth.

    A run keeps such a pair together as a branching process with one child on average survives: if q is
    the chance to be extinct after some generations, that after one more is exp(q - 1).
    """
    lost = 0.0
    for _ in range(DEPTH):
        lost = math.exp(lost - 1)
    return math.ceil(math.log(1 - recall) / math.log(lost))


def _chosen(path: Column) -> Column:
    """The min-hashes picked at a path: each with probability 1 / (similarity * their number)."""
    bound = int((1 << 20) * SIMILARITY[1] / (SIMILARITY[0] * COORDINATES))
    every = F.sequence(F.lit(0), F.lit(COORDINATES - 1))
    return F.filter(every, lambda i: F.pmod(F.xxhash64(path, i), F.lit(1 << 20)) < bound)


def _split(records: DataFrame, path: Column) -> DataFrame:
    """``records`` once for each min-hash picked at their path, with the path that it leads to."""
    next_path = F.transform(
        _chosen(path), lambda i: F.xxhash64(path, i, F.get("mins", i)))
    return records.withColumn("path", F.explode(next_path))


def _alike(sketches: list[bytes]) -> np.ndarray:
    """Whether sketches agree as those of a candidate do: 60 of 100 places, far below a link's 81."""
    packed = np.frombuffer(b"".join(sketches), np.uint8).reshape(len(sketches), -1)
    places = np.concatenate([packed >> 4, packed & 15], axis=1)
    agreed = np.empty((len(places), len(places)), np.int32)
    for row, own in enumerate(places):
        agreed[row] = (places == own).sum(axis=1)
    return agreed >= 0.6 * COORDINATES


def _agreement(own: pa.Array, other: pa.Array) -> pa.Array:
    """Places in which two sketches agree."""
    a, b = (np.frombuffer(b"".join(x.to_pylist()), np.uint8).reshape(len(x), -1) for x in (own, other))
    return pa.array((((a ^ b) & 15) == 0).sum(axis=1) + (((a ^ b) >> 4) == 0).sum(axis=1), pa.int64())


def _around_hubs(large: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges of the nodes of large buckets to their bucket's hub, and the rows that are to be split on.

    No further min-hash parts texts that are alike, so those like the hub leave the bucket. What one
    of them links to is at most 0.4 away from the hub, and has an edge to it in its turn: half of the
    places are enough for an edge, four fifths for leaving.
    """
    hubs = large.groupBy("path").agg(
        F.min(F.struct(F.xxhash64("node").alias("rank"), "node", "sketch")).alias("hub"))
    agreed = F.arrow_udf(_agreement, "long")("sketch", "hub.sketch")
    judged = write_and_read(
        large.join(hubs, "path").select("path", "node", F.col("hub.node").alias("hub"), agreed.alias("agreed")),
        "hubs")
    edges = judged.where((F.col("agreed") >= 0.5 * COORDINATES) & (F.col("node") != F.col("hub")))
    rest = judged.where((F.col("agreed") < 0.8 * COORDINATES) | (F.col("node") == F.col("hub")))
    return edges.select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct(), rest.select("path", "node")


def candidates(nodes: DataFrame, recall: float = RECALL) -> DataFrame:
    """Edges ``a, b`` between nodes that met in a bucket and look alike; a spanning tree per bucket.

    ``nodes`` is a written table ``node, mins, sketch``.
    """
    runs = F.array(*(F.lit(-1 - r).cast("long") for r in range(runs_for(recall))))
    open_ = _split(
        nodes.select("node", "sketch", "mins", F.explode(runs).alias("run")), F.col("run")).drop("mins", "run")
    found = None
    for depth in range(1, DEPTH + 1):
        sizes = open_.groupBy("path").agg(F.count("*").alias("size")).where("size > 1")
        shared = write_and_read(open_.join(sizes, "path"), "paths")
        last = depth == DEPTH
        small = shared if last else shared.where(F.col("size") <= BUCKET)
        out = compare(
            small.select(F.col("path").alias("group"), "node", F.lit(1).cast("long").alias("weight"),
                         F.col("sketch").alias("payload")), _alike, BUCKET, together=128)
        edges = out.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")).distinct()
        found = edges if found is None else found.union(edges)
        large = shared.where(F.col("size") > BUCKET)
        if last or large.isEmpty():
            return found
        linked, large = _around_hubs(large)
        found = found.union(linked)
        if large.isEmpty():
            return found
        # each node fetches its min-hashes once, however many large buckets it is in
        at = large.groupBy("node").agg(F.collect_list("path").alias("at"))
        again = at.join(nodes, "node").select("node", "sketch", "mins", F.explode("at").alias("at"))
        # read twice, for sizes and for buckets
        open_ = write_and_read(_split(again, F.col("at")).select("node", "sketch", "path"), "open-paths")
    return found


# --- links ------------------------------------------------------------------------------------


def _jaccard(sets: list[bytes]) -> np.ndarray:
    """Which sets are similar, exactly, in integers."""
    arrays = [np.frombuffer(s, np.uint64) for s in sets]
    sizes = np.array([len(a) for a in arrays])
    n = len(arrays)
    values, inverse, counts = np.unique(np.concatenate(arrays), return_inverse=True, return_counts=True)
    kept = counts > 1  # what only one set has is in no intersection
    column = (np.cumsum(kept) - 1)[inverse]
    row = np.repeat(np.arange(n), sizes)
    use = kept[inverse]
    row, column = row[use], column[use]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = np.zeros((n, n), np.float32)
    width = int(kept.sum())
    for start in range(0, width, 4096):
        a, b = np.searchsorted(column, [start, start + 4096])
        part = np.zeros((n, min(4096, width - start)), np.float32)
        part[row[a:b], column[a:b] - start] = 1
        common += part @ part.T
    above, below = SIMILARITY
    return (above + below) * common.astype(np.int64) >= above * (sizes[:, None] + sizes[None, :])


def _sets(texts: DataFrame) -> DataFrame:
    """``node, payload`` of ``text``: the whole set as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for batch in batches:
            for _, slice_texts in in_slices(batch, 0, 1 << 19):
                values = [v for v in (shingles(t, known) for t in slice_texts) if len(v)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([node_of(v) for v in values], pa.int64()),
                     pa.array([v.tobytes() for v in values], pa.binary())], names=["node", "payload"])

    return texts.select("text").mapInArrow(run, "node long, payload binary")


def similar_texts(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", recall: float = RECALL
) -> tuple[DataFrame, DataFrame]:
    """Members ``id, node`` and nodes ``node, copies, n_links, class_id``.

    A node is a set of shingles, ``copies`` its texts and ``n_links`` the texts, other than the one
    asked about, that it links to: its copies and those of linked nodes. ``class_id`` is the least id
    reachable by links. Both are written tables. A text without a word (null, empty, white space) has
    a null node: it links with nothing and is a class of its own. Repeated rows are copies; null ids
    are members like others but name no class; texts of any length are compared whole.
    """
    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    signed = write_and_read(_signatures(source), "signatures")
    nodes = write_and_read(
        signed.where("node IS NOT NULL").groupBy("node").agg(
            F.first("mins").alias("mins"), F.first("sketch").alias("sketch"),
            F.min("id").alias("first_id"), F.count("*").alias("copies")), "nodes")
    clusters = components(candidates(nodes, recall))
    near = write_and_read(
        clusters.join(nodes.select("node", "copies", "first_id"), "node"), "near")
    # one text for each node that has candidates; its set is made again rather than kept for all
    chosen = near.select(F.col("first_id").alias("chosen")).distinct()
    sets = _sets(source.join(chosen, F.col("id").eqNullSafe(F.col("chosen")), "left_semi")).groupBy("node").agg(F.first("payload").alias("payload"))
    records = near.join(sets, "node").select(
        F.col("root").alias("group"), "node", F.col("copies").alias("weight"), "payload")
    out = write_and_read(compare(records, _jaccard), "links")
    linked = out.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(out.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    named = classes.join(nodes.select("node", "first_id"), "node")
    least = named.groupBy("root").agg(F.min("first_id").alias("class_id"))
    by_node = classes.join(least, "root").select("node", "class_id")
    result = (
        nodes.select("node", "copies", "first_id").join(linked, "node", "left").join(by_node, "node", "left")
        .select("node", "copies",
                (F.coalesce("links", F.lit(0).cast("long")) + F.col("copies") - 1).alias("n_links"),
                F.coalesce("class_id", "first_id").alias("class_id")))
    return signed.select("id", "node"), write_and_read(result, "classes")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, n_links, class_id``: one row per row of ``docs``, as ``similar_texts`` defines them."""
    members, classes = similar_texts(docs, id_column, text_column)
    return members.join(classes, "node", "left").select(
        F.col("id").alias(id_column), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("class_id", "id").alias("class_id"))


def drop_near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row of ``docs`` for each class, with all its columns: the one whose id names the class.

    Of repeated rows with that id one stays. Rows without an id name no class and stay.
    """
    judged = near_duplicates(docs, id_column, text_column)
    out = judged.where(F.col("class_id") != F.col(id_column)).select(F.col(id_column).alias("_out")).distinct()
    kept = docs.join(out, docs[id_column] == out["_out"], "left_anti")
    repeated = judged.groupBy(id_column).agg(F.count("*").alias("n")).where("n > 1").select(
        F.col(id_column).alias("_again")).where("_again IS NOT NULL")
    if repeated.isEmpty():
        return kept
    again = F.col(id_column) == F.col("_again")
    return kept.join(repeated, again, "left_anti").unionByName(
        kept.join(repeated, again, "left_semi").dropDuplicates([id_column]))


def chosen_path_query(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs)
