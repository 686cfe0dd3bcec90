"""Naive Bayes search and cross-validation from counts: the text is read twice, whatever is searched.

The first pass sums the term counts of each class and fold. A fold's model is the total less that
fold, and every smoothing and model type is a formula over the same sums. The second pass scores each
row under all models at once and leaves a confusion matrix per point and fold.

Sums and models are classes x folds x terms numbers, as many as the fitted models of the library hold.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressroom.operators.evaluate import weighted_metrics
from pressroom.plans.train import Prepared

#: Numbers of a block of rows in all models that a worker holds at once.
_CELLS = 1 << 22
MODEL_TYPES = ("multinomial", "bernoulli", "complement")


@dataclass(frozen=True)
class Counts:
    """``docs`` (fold, class), ``sums`` and ``rows`` (fold, class, term): values, and rows that have the term."""

    docs: np.ndarray
    sums: np.ndarray
    rows: np.ndarray


def class_counts(train: DataFrame, n_classes: int, n_terms: int, folds: int = 1) -> Counts:
    """One pass over ``(features, label[, fold])``, combined before its shuffle."""
    fold = F.col("fold") if folds > 1 else F.lit(0)
    raw = train.select(F.col("label").cast("int").alias("label"), fold.alias("fold"), F.unwrap_udt("features").alias("v"))
    # an entry of number -1 counts the row itself
    index = F.concat(F.array(F.lit(-1)), "v.indices")
    value = F.concat(F.array(F.lit(1.0)), "v.values")
    entries = raw.select("label", "fold", F.inline(F.arrays_zip(index.alias("index"), value.alias("value"))))
    found = entries.where("value != 0").groupBy("fold", "label", "index").agg(
        F.sum("value").alias("value"), F.count("*").alias("n")).toArrow()
    at = tuple(found.column(c).to_numpy() for c in ("fold", "label", "index"))
    out = np.zeros((2, folds, n_classes, n_terms + 1))
    out[0][at] = found.column("value").to_numpy()
    out[1][at] = found.column("n").to_numpy()
    return Counts(out[0, :, :, -1], out[0, :, :, :-1], out[1, :, :, :-1])


def log_model(docs: np.ndarray, sums: np.ndarray, rows: np.ndarray, smoothing: float, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Constant per class, and weight per class and term, whose sums over a row's terms rank the classes.

    A Bernoulli row has each of its terms once. Weights of minus infinity, from no smoothing, rule a
    class out. Complement weights take the other classes' counts, so there no prior counts.
    """
    with np.errstate(divide="ignore", invalid="ignore"):
        prior = np.log(docs + smoothing) - np.log(docs.sum() + len(docs) * smoothing)
        if kind == "multinomial":
            total = sums.sum(axis=1, keepdims=True) + sums.shape[1] * smoothing
            return prior, np.log(sums + smoothing) - np.log(total)
        if kind == "bernoulli":
            theta = np.log(rows + smoothing) - np.log(docs[:, None] + 2 * smoothing)
            absent = np.log1p(-np.exp(theta))
            return prior + absent.sum(axis=1), theta - absent
        if kind == "complement":
            others = sums.sum(axis=0) - sums + smoothing
            return np.zeros(len(docs)), np.log(others.sum(axis=1, keepdims=True)) - np.log(others)
    raise ValueError(f"unknown model type {kind!r}, expected one of {MODEL_TYPES}")


def _models(counts: Counts, points: list[dict], without_fold: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Constants (fold, point, class), weights (fold, term, point, class), and which points are Bernoulli."""
    total = [x.sum(axis=0) for x in (counts.docs, counts.sums, counts.rows)]
    constants, weights = [], []
    for fold in range(len(counts.docs) if without_fold else 1):
        part = [t - x[fold] if without_fold else t
                for t, x in zip(total, (counts.docs, counts.sums, counts.rows))]
        made = [log_model(*part, p.get("smoothing", 1.0), p.get("modelType", "multinomial")) for p in points]
        constants.append([c for c, _ in made])
        weights.append(np.stack([w.T for _, w in made], axis=1))
    return np.array(constants), np.stack(weights), np.array([p.get("modelType") == "bernoulli" for p in points])


def _confusions(rows: DataFrame, models: tuple, folds: int) -> DataFrame:
    """``trial, fold, label, prediction, n`` of all rows under all models of their fold."""
    sent = rows.sparkSession.sparkContext.broadcast(models)

    def score(batch: pa.RecordBatch) -> pa.RecordBatch:
        constants, weights, presence = sent.value
        label, fold = batch.column("label").to_numpy(), batch.column("fold").to_numpy()
        lengths = batch.column("indices").value_lengths().to_numpy()
        term = batch.column("indices").flatten().to_numpy()
        value = batch.column("values").flatten().to_numpy()
        of = np.repeat(np.arange(batch.num_rows), lengths)
        scores = constants[fold].copy()
        times = np.where(presence[None, :], (value != 0)[:, None], value[:, None])
        with np.errstate(invalid="ignore"):
            each = np.where(times[:, :, None] != 0, weights[fold[of], term] * times[:, :, None], 0.0)
        has = np.flatnonzero(lengths)
        if len(has):
            scores[has] += np.add.reduceat(each, (np.cumsum(lengths) - lengths)[has], axis=0)
        best = scores.argmax(axis=2)
        trial = np.broadcast_to(np.arange(best.shape[1]), best.shape)
        keys = np.stack([trial.reshape(-1), np.repeat(fold, best.shape[1]), np.repeat(label, best.shape[1]), best.reshape(-1)])
        found, n = np.unique(keys, axis=1, return_counts=True)
        return pa.RecordBatch.from_arrays(
            [*(pa.array(x.astype(np.int32)) for x in found), pa.array(n)],
            names=["trial", "fold", "label", "prediction", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, weights, _ = sent.value
        per_entry = weights.shape[2] * weights.shape[3]
        for batch in batches:
            entries = np.cumsum(batch.column("indices").value_lengths().to_numpy().astype(np.int64) + 1)
            lot = entries * per_entry // _CELLS
            bounds = [0, *(np.flatnonzero(np.diff(lot)) + 1).tolist(), batch.num_rows]
            for a, b in zip(bounds, bounds[1:]):
                if b > a:
                    yield score(batch.slice(a, b - a))

    fold = F.col("fold") if folds > 1 else F.lit(0)
    raw = rows.select(F.col("label").cast("int").alias("label"), fold.cast("int").alias("fold"), F.unwrap_udt("features").alias("v"))
    partial = raw.select("label", "fold", F.col("v.indices").alias("indices"), F.col("v.values").alias("values")).mapInArrow(
        run, "trial int, fold int, label int, prediction int, n long")
    return partial.groupBy("trial", "fold", "label", "prediction").agg(F.sum("n").alias("n"))


def _terms(prepared: Prepared) -> int:
    return len(prepared.text_model.stages[-1].vocabulary)


def _named(scores: DataFrame, points: list[dict]) -> DataFrame:
    spark = scores.sparkSession
    names = spark.createDataFrame([(i, json.dumps(p)) for i, p in enumerate(points)], "trial int, params string")
    return scores.join(F.broadcast(names), "trial")  # a row per point


def search_counts(prepared: Prepared, points: list[dict]) -> DataFrame:
    """``trial, params, accuracy, precision, recall, f1`` of every point on the test part."""
    counts = class_counts(prepared.train, len(prepared.labels), _terms(prepared))
    scored = _confusions(prepared.test, _models(counts, points, without_fold=False), 1)
    return _named(weighted_metrics(scored, "trial"), points).select(
        "trial", "params", "accuracy", "precision", "recall", "f1")


def cross_validate_counts(prepared: Prepared, points: list[dict], folds: int) -> DataFrame:
    """``trial, params, f1, f1_std`` over the folds (column ``fold``) of the training part."""
    counts = class_counts(prepared.train, len(prepared.labels), _terms(prepared), folds)
    scored = _confusions(prepared.train, _models(counts, points, without_fold=True), folds)
    by_fold = weighted_metrics(scored, "trial", "fold")
    return _named(by_fold.groupBy("trial").agg(
        F.avg("f1").alias("f1"), F.stddev_pop("f1").alias("f1_std")), points).select("trial", "params", "f1", "f1_std")
