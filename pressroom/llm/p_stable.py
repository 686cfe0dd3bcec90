"""Near-duplicate vectors by Euclidean p-stable hashing.

Normalised vectors are projected on random Gaussian directions; a projection, shifted at random and
cut into steps, is one digit of a hash, and several digits name a bucket of a table. Vectors with the
wanted cosine are close, so that in some table they share the bucket with the probability asked for.
Buckets are compared by their exact cosines; records so connected then meet as a whole, and all of
their links are counted exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressroom.llm.links import compare, components
from pressroom.session import write_and_read

COSINE = 0.93
#: Step of a projection, in distances of two vectors that just link.
STEP = 4.0
#: Digits of a bucket's name: more of them for more vectors, as buckets must not grow with the input.
DIGITS_AT_LEAST, FROM_ROWS, ROWS_PER_DIGIT = 8, 1 << 16, 2.5
#: Probability that a pair of the least cosine shares a bucket in some table.
RECALL = 0.999


def digits_for(rows: int) -> int:
    """Digits for so many vectors: one more for every further factor of ``ROWS_PER_DIGIT``."""
    return DIGITS_AT_LEAST + max(0, math.ceil(math.log(max(rows, 1) / FROM_ROWS, ROWS_PER_DIGIT)))


def tables_for(digits: int, recall: float = RECALL) -> int:
    """Tables until a pair of the least cosine is found with that probability."""
    w = STEP
    same = (math.erf(w / math.sqrt(2))
            - 2 / (math.sqrt(2 * math.pi) * w) * (1 - math.exp(-w * w / 2)))
    return math.ceil(math.log(1 - recall) / math.log(1 - same ** digits))


def buckets(unit: np.ndarray, digits: int, tables: int, cosine: float = COSINE) -> np.ndarray:
    """Bucket of each unit vector in each table."""
    random = np.random.default_rng(unit.shape[1])
    step = STEP * math.sqrt(2 - 2 * cosine)
    directions = random.standard_normal((unit.shape[1], tables * digits))
    shifts = random.uniform(0, step, tables * digits)
    cells = np.floor((unit @ directions + shifts) / step).astype(np.int64).reshape(len(unit), tables, digits)
    multiply = random.integers(1, 1 << 62, digits, np.int64) * 2 + 1
    name = np.arange(tables, dtype=np.int64) * np.int64(0x9E3779B97F4A7C1)
    return (cells * multiply).sum(axis=2) + name


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision."""
    largest = np.abs(vectors).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    scaled = vectors / largest
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _rows(rows: list, kind: str) -> tuple[np.ndarray, list[bytes]]:
    """Which vectors count, and those as bytes: not null, not zero, no null or non-finite part."""
    valid, data = [], []
    for i, row in enumerate(rows):
        if row is None or any(x is None for x in row):
            continue
        vector = np.array(row, np.float64)
        if len(vector) and np.isfinite(vector).all() and vector.any():
            valid.append(i)
            data.append(vector.astype(kind).tobytes())
    return np.array(valid, np.int64), data


def _close(cosine: float, kind: str):
    def close(payloads: list[bytes]) -> np.ndarray:
        by_length: dict[int, list[int]] = {}
        for i, p in enumerate(payloads):
            by_length.setdefault(len(p), []).append(i)
        out = np.zeros((len(payloads), len(payloads)), bool)
        for at in by_length.values():
            unit = _unit(np.frombuffer(b"".join(payloads[i] for i in at), kind).reshape(len(at), -1).astype(np.float64))
            out[np.ix_(at, at)] = unit @ unit.T >= cosine
        return out | out.T

    return close


def _nodes(vectors: DataFrame, kind: str) -> DataFrame:
    """``id, label, node, payload``: equal vectors of a label share a node; no node for one that can't link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column(1).to_pylist()
            nodes: list[int | None] = [None] * batch.num_rows
            payloads: list[bytes | None] = [None] * batch.num_rows
            valid, data = _rows(batch.column(2).to_pylist(), kind)
            for i, value in zip(valid.tolist(), data):
                if labels[i] is not None:
                    nodes[i] = xxhash.xxh3_64_intdigest(f"{labels[i]!r} ".encode() + value) - (1 << 63)
                    payloads[i] = value
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(nodes, pa.int64()), pa.array(payloads, pa.binary())],
                names=["id", "label", "node", "payload"])

    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema}
    return vectors.mapInArrow(run, f"id {kinds['id']}, label {kinds['label']}, node long, payload binary")


def _bucketed(nodes: DataFrame, kind: str, digits: int, tables: int, cosine: float) -> DataFrame:
    """``group, node`` for each table; the label is part of the group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, labels = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            payloads = batch.column(2).to_pylist()
            sizes = np.array([len(p) for p in payloads])
            for size in np.unique(sizes).tolist():
                every = np.flatnonzero(sizes == size)
                for at in (every[k:k + 1024] for k in range(0, len(every), 1024)):
                    vectors = np.frombuffer(b"".join(payloads[i] for i in at), kind).reshape(len(at), -1)
                    groups = buckets(_unit(vectors.astype(np.float64)), digits, tables, cosine)
                    groups ^= labels[at][:, None]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(groups.reshape(-1)), pa.array(np.repeat(names[at], tables))],
                        names=["group", "node"])

    return nodes.select("node", F.xxhash64("label").alias("label"), "payload").mapInArrow(
        run, "group long, node long")


def similar_vectors(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding",
    label_column: str = "label", cosine: float = COSINE, recall: float = RECALL,
) -> DataFrame:
    """``id, n_links, component_id``: one row per row of ``vectors``.

    Two vectors link if their labels are equal and not null and their cosine, in double precision, is
    at least ``cosine``. Vectors that are null, empty or zero, or hold a null or non-finite component,
    and vectors without a label link with nothing and are components of their own; so are vectors of
    different lengths to each other. Equal vectors, repeated rows among them, are counted as links
    without being compared one by one. ``component_id`` is the least id reachable by links.
    """
    source = vectors.select(
        F.col(id_column).alias("id"), F.col(label_column).alias("label"), F.col(vector_column).alias("v"))
    kind = "<f4" if source.schema["v"].dataType.elementType.simpleString() == "float" else "<f8"
    members = write_and_read(_nodes(source, kind), "vectors")
    nodes = write_and_read(
        members.where("node IS NOT NULL").groupBy("node").agg(
            F.first("label").alias("label"), F.first("payload").alias("payload"),
            F.min("id").alias("first_id"), F.count("*").alias("copies")), "vector-nodes")
    digits = digits_for(nodes.count())
    found = write_and_read(_bucketed(nodes, kind, digits, tables_for(digits, recall), cosine), "buckets")
    # most buckets hold one vector; only the others carry their vectors on
    shared = found.groupBy("group").agg(F.count("*").alias("size")).where("size > 1").select("group")
    records = found.join(shared, "group").join(nodes.select("node", "payload"), "node").select(
        "group", "node", F.lit(1).cast("long").alias("weight"), "payload")
    close = _close(cosine, kind)
    edges = compare(records, close, together=256).where("node <> root").select(
        F.col("node").alias("a"), F.col("root").alias("b"))
    linked = write_and_read(components(edges), "vector-components")
    whole = linked.join(nodes.select("node", "copies", "payload"), "node").select(
        F.col("root").alias("group"), "node", F.col("copies").alias("weight"), "payload")
    links = compare(whole, close, together=256).groupBy("node").agg(F.sum("links").alias("links"))
    least = linked.join(nodes.select("node", "first_id"), "node").groupBy("root").agg(
        F.min("first_id").alias("component_id"))
    by_node = nodes.select("node", "copies", "first_id").join(links, "node", "left").join(
        linked.join(least, "root").select("node", "component_id"), "node", "left").select(
        "node", (F.coalesce("links", F.lit(0).cast("long")) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component_id", "first_id").alias("component_id"))
    return members.select("id", "node").join(by_node, "node", "left").select(
        F.col("id").alias(id_column), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"))


def embedding_query(vectors: DataFrame) -> DataFrame:
    return similar_vectors(vectors).withColumn("kept", F.col("vec_id") == F.col("component_id"))
