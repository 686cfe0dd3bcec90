"""Toxicity by class-conditional Kneser-Ney models with a shared backoff.

A class has the distribution of its words by the number of its texts that hold them. What the discount
leaves comes from the class's continuation counts, the number of different words a word follows, and what
that leaves from both classes together. A rare expression therefore looks alike to both, and one that
always follows the same word counts by its texts. A toxic text is mostly ordinary words: its likelihood is
that of a mixture with a small share of the toxic class. The log-likelihoods of a text as toxic and as
ordinary are compared twice: over all its words, divided by their number, and in overlapping windows that
cover it, where a short passage in a long text would show. The windows' likelihood ratios are averaged, so
that more windows are no more likely to look toxic by chance. A logistic curve, fitted on labelled rows
left out of the counts, turns the two comparisons into a score.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from itertools import filterfalse

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressroom.llm.common import fold
from pressroom.llm.pretokens import MEMO_SIZE

#: Labelled rows that the classifier learns from at most, chosen by the hash of their ids.
FIT_ROWS = 20_000
#: One labelled row in so many sets the logistic curve and is not counted.
CALIBRATION = 5
#: Absolute discount.
DISCOUNT = 0.75
#: Share of a toxic text's words that the toxic class gives.
SHARE = 0.01
#: Words of half a window: windows are two halves and overlap by one.
HALF = 64
THRESHOLD = 0.7

_TOKEN = re.compile(r"[^\W_]+")


def tokens(text: str | None) -> list[str]:
    """Runs of letters and digits, lower-cased: marks stuck to a word don't hide it."""
    return _TOKEN.findall((text or "").lower())


def _hash(word: str) -> int:
    return xxhash.xxh64_intdigest(word)


#: Hashes of words that a worker met.
_known: dict[str, int] = {}


def _hashes(words: list[str]) -> np.ndarray:
    if len(_known) > MEMO_SIZE:
        _known.clear()
    for word in filterfalse(_known.__contains__, set(words)):
        _known[word] = _hash(word)
    return np.fromiter(map(_known.__getitem__, words), np.uint64, len(words))


class Ratios(Mapping):
    """Log-likelihood ratios (toxic over ordinary) by word, held as sorted hashes: 16 bytes a word."""

    def __init__(self, words: np.ndarray = np.zeros(0, np.uint64), values: np.ndarray = np.zeros(0)):
        order = np.argsort(words)
        self.words, self.values = words[order], values[order]

    def of(self, hashes: np.ndarray, other: float) -> np.ndarray:
        """The ratio of each hash, ``other`` for one that is not here."""
        if not len(self.words):
            return np.full(len(hashes), other)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, self.values[at], other)

    def __getitem__(self, word: str) -> float:
        value = self.of(np.array([_hash(word)], np.uint64), np.nan)[0]
        if np.isnan(value):
            raise KeyError(word)
        return float(value)

    def __iter__(self) -> Iterator[int]:
        return iter(self.words.tolist())

    def __len__(self) -> int:
        return len(self.words)

    def __eq__(self, other: object) -> bool:
        if isinstance(other, Ratios):
            return np.array_equal(self.words, other.words) and np.array_equal(self.values, other.values)
        return isinstance(other, Mapping) and not self and not other

    __hash__ = None


@dataclass(frozen=True)
class Model:
    """Log-likelihood ratio (toxic text over ordinary) of the known words and of any other, and the curve.

    Any other's is zero: a word that neither class has tells nothing of them.
    """

    ratios: Ratios
    other: float
    weights: tuple[float, float, float]

    def features(self, text: str | None) -> tuple[float, float]:
        """Mean ratio of a text's words, and the log of its windows' mean likelihood ratio.

        If one window were toxic and any as likely, that mean would be the ratio of the whole text. Under
        the ordinary class it is 1 on average for any number of windows. Zeros for a text without a word.
        """
        words = tokens(text)
        n = len(words)
        if not n:
            return 0.0, 0.0
        distinct, which = np.unique(_hashes(words), return_inverse=True)
        ratio = self.ratios.of(distinct, self.other)[which]
        order = np.argsort(which, kind="stable")
        last = np.full(n, -1)  # the place before where the word stood
        again = which[order[1:]] == which[order[:-1]]
        last[order[1:][again]] = order[:-1][again]
        half = np.arange(n) // HALF
        own = np.bincount(half, np.where(last < half * HALF, ratio, 0.0))
        if len(own) > 1:  # words that are new to a window which began a half before
            new = np.bincount(half, np.where(last < (half - 1) * HALF, ratio, 0.0))
            own = own[:-1] + new[1:]
        most = own.max()
        return float(ratio.mean()), float(most + np.log(np.exp(own - most).mean()))

    def score(self, text: str | None) -> float:
        mean, passage = self.features(text)
        a, b, c = self.weights
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, a * mean + b * passage + c))))


def _counts(labelled: DataFrame) -> DataFrame:
    """``word`` (its hash), and by class the texts that hold it and the different words before it.

    ``labelled`` has ``text`` and ``toxic``. Tasks send a pair of words once per class and batch, and
    with it the texts where the word first stands in that pair.
    """

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[tuple[int, int, int], int] = {}
            for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist()):
                words = tokens(text)
                found: set[int] = set()
                before = ""
                for word, number in zip(words, _hashes(words).view(np.int64).tolist()):
                    key = toxic, _hash(f"{before} {word}") - (1 << 63), number
                    seen[key] = seen.get(key, 0) + (number not in found)
                    found.add(number)
                    before = word
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in seen], pa.int32()), pa.array([k[1] for k in seen], pa.int64()),
                 pa.array([k[2] for k in seen], pa.int64()), pa.array(list(seen.values()), pa.int64())],
                names=["toxic", "pair", "word", "texts"])

    found = labelled.select("text", "toxic").mapInArrow(pairs, "toxic int, pair long, word long, texts long")
    return (found.groupBy("toxic", "pair").agg(F.first("word").alias("word"), F.sum("texts").alias("texts"))
            .groupBy("word").agg(
                F.sum(F.expr("if(toxic = 1, texts, 0)")).alias("in_toxic"),
                F.sum(F.expr("if(toxic = 1, 0, texts)")).alias("in_other"),
                F.sum(F.expr("if(toxic = 1, 1, 0)")).alias("after_toxic"),
                F.sum(F.expr("if(toxic = 1, 0, 1)")).alias("after_other")))


def _discounted(counts: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Probabilities by class (columns) from counts, and from ``lower`` what the discount leaves."""
    n = counts.sum(axis=0)
    return np.maximum(counts - DISCOUNT, 0) / n + DISCOUNT * (counts > 0).sum(axis=0) / n * lower


def _ratios(texts: np.ndarray, contexts: np.ndarray) -> np.ndarray:
    """Log-likelihood ratio of each word, from its texts and its contexts by class (two columns)."""
    classes = (texts > 0).sum(axis=1, keepdims=True) + 1.0
    p = _discounted(texts, _discounted(contexts, classes / (classes.sum() + 1)))
    return np.log1p(SHARE * (p[:, 0] / p[:, 1] - 1))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> tuple[float, float, float]:
    """Weights and intercept by Newton steps; classes weigh alike, the ridge keeps them finite."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    weight = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    w = np.zeros(3)
    penalty = np.diag([ridge, ridge, 1e-9]) / 50
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -500, 500)))
        gradient = z.T @ (weight * (p - y)) + penalty @ w
        hessian = (z * (weight * p * (1 - p))[:, None]).T @ z + penalty + 1e-9 * np.eye(3)
        w = w - np.clip(np.linalg.solve(hessian, gradient), -5, 5)
    a = w[:2] / scale
    return float(a[0]), float(a[1]), float(w[2] - a @ mean)


def fit(labelled: DataFrame) -> Model:
    """A model of rows ``text, toxic, calibration``: the last tells rows that set the curve.

    ``labelled`` must be bounded, as ``training_rows`` makes it. Without a row of each class in both
    parts nothing can be compared: every text then gets the share of toxic rows (0 without a row).
    """
    counts = _counts(labelled.where(~F.col("calibration"))).toArrow()
    share = labelled.agg(F.coalesce(F.avg("toxic"), F.lit(0.0)).alias("share")).first()["share"]
    share = min(max(share, 1e-6), 1 - 1e-6)
    constant = Model(Ratios(), 0.0, (0.0, 0.0, float(np.log(share / (1 - share)))))
    texts, contexts = (
        np.column_stack([counts[c + "_toxic"].to_numpy(), counts[c + "_other"].to_numpy()]).astype(float)
        for c in ("in", "after"))
    if not texts.sum(axis=0).all():
        return constant
    model = Model(
        Ratios(counts["word"].to_numpy().view(np.uint64), _ratios(texts, contexts)), 0.0, (0.0, 0.0, 0.0))
    shown = labelled.where("calibration").select("toxic", _features(labelled, model)(F.col("text")).alias("x")).toArrow()
    y = shown["toxic"].to_numpy()
    if not 0 < y.sum() < len(y):
        return constant
    x = np.array(shown["x"].to_pylist(), float)
    return Model(model.ratios, model.other, _logistic(x, y.astype(float)))


def _features(docs: DataFrame, model: Model):
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def features(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        for batch in batches:
            yield pa.array([model.features(text.as_py()) for text in batch], pa.list_(pa.float64()))

    return F.arrow_udf(features, "array<double>")


def training_rows(
    docs: DataFrame, labels: DataFrame, allowed: Column, id_column: str = "doc_id",
    text_column: str = "text", label_column: str = "toxic", rows: int = FIT_ROWS,
) -> DataFrame:
    """``text, toxic, calibration`` of at most ``rows`` labelled documents whose id is ``allowed``.

    An id with several labels is toxic if one says so; null ids and labels are left out. Only ids go
    through the choice; it is broadcast, as it has a bound.
    """
    key = F.col(id_column)
    chosen = (
        labels.where(key.isNotNull() & F.col(label_column).isNotNull() & allowed)
        .groupBy(key.alias("_id")).agg(F.max(F.when(F.col(label_column) == 1, 1).otherwise(0)).alias("toxic"))
        .orderBy(F.xxhash64("_id"), "_id").limit(rows)
        .withColumn("calibration", F.pmod(F.xxhash64("_id", F.lit(1)), F.lit(CALIBRATION)) == 0))
    texts = docs.select(key.alias("_key"), F.col(text_column).alias("text"))
    return texts.join(F.broadcast(chosen), F.col("_key") == F.col("_id")).select("text", "toxic", "calibration")


def scorer(docs: DataFrame, model: Model):
    """A column function: the score of a text under ``model``, which goes to each executor once."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        for batch in batches:
            yield pa.array([model.score(text.as_py()) for text in batch], pa.float64())

    return F.arrow_udf(score, "double")


def learned(docs: DataFrame, labels: DataFrame) -> Model:
    """The production model: labels only of ids whose crc32 modulo 3 is not 1."""
    return fit(training_rows(docs, labels, fold(F.col("doc_id"), 3) != 1))


def with_toxicity(docs: DataFrame, model: Model, text: str = "text", score: str = "toxicity") -> DataFrame:
    """``docs`` with the score of each whole text; a column of that name is replaced.

    Null and empty texts have no word and get what the curve says of none; repeated rows score alike.
    """
    return docs.withColumn(score, scorer(docs, model)(F.col(text)))


def toxicity_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = with_toxicity(docs.select("doc_id", "text"), learned(docs, labels), score="score")
    return scored.select(
        "doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
