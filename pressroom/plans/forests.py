"""Forest search by nested fits: one deep, large forest stands for every smaller one of its kind.

The first k trees of a forest are a forest of k trees. A tree cut at a depth is the tree grown to that
depth, and one cut at the nodes whose best split gains too little is the tree grown with that least
gain, since each node keeps its own class counts and its split's gain. So ``numTrees``, ``maxDepth`` and
``minInfoGain`` cost no fits, only a scoring pass over the test rows for all of them at once. What changes
the rows or the splits that a node may choose (``minInstancesPerNode`` too: a node takes its next best
split) has a fit of its own.

Cut trees equal single fits exactly where every node sees all features. Where features are drawn at
random, or trees are left out, a single fit draws other random numbers: the same kind of forest, other draws.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressroom.operators.evaluate import weighted_metrics
from pressroom.plans.models import fit_classifier
from pressroom.plans.train import Prepared
from pressroom.session import scratch_path

#: Parameters that are read off one forest.
NESTED = ("numTrees", "maxDepth", "minInfoGain")
#: Parameters of how a fit runs, which leave its result as it is.
RUNNING = ("cacheNodeIds", "checkpointInterval")
# The library's own values where a point names none.
_DEFAULTS = {"numTrees": 20, "maxDepth": 5, "minInfoGain": 0.0}
#: Numbers of a block of rows that a worker holds at once.
_CELLS = 1 << 24


@dataclass(frozen=True)
class Forest:
    """Nodes of all trees in one row of arrays, each tree from its root in ``roots``, children after parents."""

    roots: np.ndarray
    feature: np.ndarray     # -1 at a leaf
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    depth: np.ndarray
    gain: np.ndarray
    prediction: np.ndarray
    shares: np.ndarray      # of each class among a node's rows


def forest_of(spark: SparkSession, model: RandomForestClassificationModel) -> Forest:
    """The nodes of a fitted forest, which its saved form holds with their class counts and gains."""
    path = scratch_path(spark, "forest")
    model.write().save(path)
    data = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    table = data.select(
        "treeID", "id", "prediction", "impurityStats", "gain", "leftChild", "rightChild",
        F.col("split.featureIndex").alias("feature"), F.col("split.numCategories").alias("categories"),
        F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold")).toArrow().sort_by(
            [("treeID", "ascending"), ("id", "ascending")])
    tree, id_, left, right, feature, categories = (
        table.column(c).to_numpy() for c in ("treeID", "id", "leftChild", "rightChild", "feature", "categories"))
    if (categories[left >= 0] >= 0).any():
        raise ValueError("splits by category are not supported")
    roots = np.flatnonzero(np.append(True, np.diff(tree) != 0))
    base = np.repeat(roots, np.diff(np.append(roots, len(tree))))
    inner = left >= 0
    left, right = np.where(inner, left + base, -1), np.where(inner, right + base, -1)
    depth = np.zeros(len(tree), np.int32)
    for node in np.flatnonzero(inner):  # parents come before their children
        depth[left[node]] = depth[right[node]] = depth[node] + 1
    stats = np.array(table.column("impurityStats").to_pylist(), float)
    totals = stats.sum(axis=1, keepdims=True)
    shares = np.divide(stats, totals, out=np.zeros_like(stats), where=totals > 0)
    return Forest(
        roots, np.where(inner, feature, -1), table.column("threshold").to_numpy(zero_copy_only=False).astype(float),
        left, right, depth, table.column("gain").to_numpy(), table.column("prediction").to_numpy(), shares)


def ends_of(forest: Forest, cuts: Sequence[tuple[int, float]]) -> np.ndarray:
    """For each cut (greatest depth, least gain) and node, the node where a row that reaches it has ended.

    Minus one above the ends. As in a fit, a node whose children both end there with one prediction ends too.
    """
    inner = np.flatnonzero(forest.feature >= 0)
    ends = np.empty((len(cuts), len(forest.feature)), np.int32)
    for row, (most, least) in zip(ends, cuts):
        last = (forest.feature < 0) | (forest.depth >= most) | (forest.gain < least)
        for node in inner[::-1]:
            a, b = forest.left[node], forest.right[node]
            last[node] |= last[a] and last[b] and forest.prediction[a] == forest.prediction[b]
        row[:] = np.where(last, np.arange(len(last)), -1)
        for node in inner:
            if row[node] >= 0:
                row[forest.left[node]] = row[forest.right[node]] = row[node]
    return ends


def _values(index: np.ndarray, value: np.ndarray, row: np.ndarray, rows: int, used: np.ndarray) -> np.ndarray:
    """The used features of sparse rows: one row per feature."""
    out = np.zeros((len(used), rows))
    if len(used):
        at = np.minimum(np.searchsorted(used, index), len(used) - 1)
        hit = used[at] == index
        out[at[hit], row[hit]] = value[hit]
    return out


def predictions(forest: Forest, ends: np.ndarray, sizes: Sequence[int], values: np.ndarray, used: np.ndarray) -> np.ndarray:
    """Predictions by cut, size and row. ``sizes`` (ascending) are numbers of trees; ties go to the first class."""
    rows = values.shape[1]
    place = np.searchsorted(used, np.where(forest.feature < 0, used[0] if len(used) else 0, forest.feature))
    votes = np.zeros((len(ends), rows, forest.shares.shape[1]))
    out = np.empty((len(ends), len(sizes), rows), np.int32)
    each = np.arange(rows)
    for number, root in enumerate(forest.roots):
        node = np.full(rows, root)
        moving = each[forest.feature[node] >= 0]
        while len(moving):
            here = node[moving]
            goes_left = values[place[here], moving] <= forest.threshold[here]
            node[moving] = np.where(goes_left, forest.left[here], forest.right[here])
            moving = moving[forest.feature[node[moving]] >= 0]
        for k in range(len(ends)):
            votes[k] += forest.shares[ends[k][node]]
        for k, size in enumerate(sizes):
            if size == number + 1:
                out[:, k] = votes.argmax(axis=2)
    return out


def nested_confusions(
    rows: DataFrame, forest: Forest, cuts: Sequence[tuple[int, float]], sizes: Sequence[int],
) -> DataFrame:
    """``cut, size, label, prediction, n`` of ``(features, label)`` under each cut and each number of trees.

    One pass over the rows; what shuffles are counts. The forest goes to every task, as in predicting.
    """
    if list(sizes) != sorted(set(sizes)) or sizes[-1] > len(forest.roots):
        raise ValueError(f"sizes must ascend to at most {len(forest.roots)} trees, not {list(sizes)}")
    used = np.unique(forest.feature[forest.feature >= 0])
    sent = rows.sparkSession.sparkContext.broadcast((forest, ends_of(forest, cuts), used))
    classes = forest.shares.shape[1]
    block = max(1, _CELLS // max(1, len(used), len(cuts) * max(classes, len(sizes))))

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        forest, ends, used = sent.value
        label = batch.column("label").to_numpy()
        lengths = batch.column("indices").value_lengths().to_numpy()
        of = np.repeat(np.arange(batch.num_rows), lengths)
        values = _values(
            batch.column("indices").flatten().to_numpy(), batch.column("values").flatten().to_numpy(), of,
            batch.num_rows, used)
        found = predictions(forest, ends, sizes, values, used)
        shape = found.shape
        cut = np.broadcast_to(np.arange(shape[0])[:, None, None], shape)
        size = np.broadcast_to(np.array(sizes)[:, None], shape)
        keys = np.stack([x.reshape(-1) for x in (cut, size, np.broadcast_to(label, shape), found)])
        keys, n = np.unique(keys, axis=1, return_counts=True)
        return pa.RecordBatch.from_arrays(
            [*(pa.array(x.astype(np.int32)) for x in keys), pa.array(n)],
            names=["cut", "size", "label", "prediction", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, block):
                yield count(batch.slice(start, block))

    sparse = rows.select(F.col("label").cast("int").alias("label"), F.unwrap_udt("features").alias("v"))
    # a dense vector has no indices: its values stand at 0, 1, …
    indices = F.coalesce("v.indices", F.when(F.size("v.values") > 0, F.sequence(
        F.lit(0), F.size("v.values") - 1)).otherwise(F.array().cast("array<int>")))
    partial = sparse.select("label", indices.alias("indices"), F.col("v.values").alias("values")).mapInArrow(
        run, "cut int, size int, label int, prediction int, n long")
    return partial.groupBy("cut", "size", "label", "prediction").agg(F.sum("n").alias("n"))


def _kind(point: dict) -> str:
    """Points of one kind share a forest. A single tree is grown without a draw of rows."""
    own = {k: v for k, v in point.items() if k not in NESTED + RUNNING}
    return json.dumps([own, point.get("numTrees", _DEFAULTS["numTrees"]) == 1], sort_keys=True)


def kinds_of(points: Iterable[dict]) -> dict[str, list[tuple[int, dict]]]:
    """The numbered points by the forest that serves them."""
    kinds: dict[str, list[tuple[int, dict]]] = {}
    for trial, point in points:
        kinds.setdefault(_kind(point), []).append((trial, point))
    return kinds


def search_forests(prepared: Prepared, points: Iterable[tuple[int, dict]], seed: int = 42) -> DataFrame:
    """``trial, params, accuracy, precision, recall, f1`` of numbered points on the test part.

    As many fits as there are kinds of points: 480 for the 230,400 points of ``tune.RF_RANGES``. Points
    that differ only in how a fit runs have the same scores.
    """
    spark = prepared.train.sparkSession
    scores = {}
    kinds = kinds_of(points)
    for kind in kinds.values():
        full = [_DEFAULTS | p for _, p in kind]
        sizes = sorted({p["numTrees"] for p in full})
        cuts = sorted({(p["maxDepth"], float(p["minInfoGain"])) for p in full})
        params = {k: v for k, v in full[0].items() if k not in RUNNING} | {
            "numTrees": sizes[-1], "maxDepth": cuts[-1][0], "minInfoGain": min(g for _, g in cuts)}
        forest = forest_of(spark, fit_classifier(prepared.train, "rf", {"seed": seed} | params))
        counts = nested_confusions(prepared.test, forest, cuts, sizes)
        found = {(r["cut"], r["size"]): r for r in weighted_metrics(counts, "cut", "size").collect()}  # a row per point
        for (trial, given), p in zip(kind, full):
            r = found.get((cuts.index((p["maxDepth"], float(p["minInfoGain"]))), p["numTrees"]))
            scores[trial] = (json.dumps(given), *((r["accuracy"], r["precision"], r["recall"], r["f1"]) if r else [None] * 4))
    return spark.createDataFrame(
        [(t, *s) for t, s in sorted(scores.items())],
        "trial long, params string, accuracy double, precision double, recall double, f1 double")
