"""The four classifier families behind one ``fit_classifier``."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from multiprocessing.pool import ThreadPool

from pyspark import keyword_only
from pyspark.ml import Model, PipelineModel, Transformer
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.feature import Binarizer
from pyspark.ml.param.shared import HasInputCols, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressroom.session import ensure_checkpoint_dir

FAMILIES = ("lr", "nb", "rf", "boosted")

# The main trainer's logistic regression.
MAIN_PARAMS = {"maxIter": 15, "regParam": 0.3, "elasticNetParam": 0.0}

# Fixed value: rounds of boosting.
ROUNDS = 10

#: Bytes of a partition's rows as trees hold them, 4 for each feature whether a row has it or not.
DENSE_BYTES = 1 << 28


class LargestMargin(
    Transformer, HasInputCols, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable
):
    """Predict the class whose binary classifier has the largest raw margin, first on ties."""

    @keyword_only
    def __init__(self, *, inputCols=None, predictionCol="prediction"):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        margins = F.array(
            *(F.get(F.unwrap_udt(c)["values"], F.lit(1)) for c in self.getInputCols())
        )
        best = F.array_position(margins, F.array_max(margins)) - 1
        return dataset.withColumn(self.getPredictionCol(), best.cast("double")).drop(
            *self.getInputCols()
        )


class Hidden(Transformer, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Drop working columns."""

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.drop(*self.getInputCols())


def fit_boosted(
    train: DataFrame,
    n_classes: int,
    rounds: int = ROUNDS,
    max_depth: int = 6,
    learning_rate: float = 0.3,
    subsample: float = 1.0,
    colsample_bytree: float = 1.0,
    gamma: float = 0.0,
    parallelism: int = 2,
    seed: int = 42,
    **_engine_only,
) -> PipelineModel:
    """Gradient-boosted trees for several classes: one binary booster per class, largest margin wins.

    An approximation of a softmax objective, with other numbers by design. Every round sees all
    rows, and their number doesn't depend on how many there are. ``colsample_bytree`` applies per node and ``gamma`` is the least
    information gain of a split. Parameters that only pick an engine or a device are accepted and
    unused. Trees hold every feature of a row densely while training, so keep the vocabulary small.
    """
    # Every ten rounds the running predictions are checkpointed there, which cuts their lineage.
    ensure_checkpoint_dir(train.sparkSession)

    def one(k: int, rows: DataFrame) -> Model:
        booster = GBTClassifier(
            labelCol="is_class", featuresCol="features", predictionCol=f"class_{k}",
            maxIter=rounds, maxDepth=max_depth, stepSize=learning_rate, subsamplingRate=subsample,
            featureSubsetStrategy=str(colsample_bytree) if colsample_bytree < 1 else "all",
            minInfoGain=gamma, seed=seed,
        ).setRawPredictionCol(f"margin_{k}").setProbabilityCol(f"probability_{k}")
        return booster.fit(
            rows.select("features", (F.col("label") == k).cast("double").alias("is_class"))
        )

    with dense_parts(train) as dealt, ThreadPool(min(parallelism, n_classes)) as pool:
        boosters = pool.map(lambda k: one(k, dealt), range(n_classes))
    classes = range(n_classes)
    return PipelineModel(
        stages=[
            *boosters,
            LargestMargin(inputCols=[f"margin_{k}" for k in classes], predictionCol="prediction"),
            Hidden(inputCols=[f"{c}_{k}" for c in ("class", "probability") for k in classes]),
        ]
    )


@contextmanager
def dense_parts(train: DataFrame) -> Iterator[DataFrame]:
    """``train`` in parts that stay small when trees make its rows dense; one small part stays as it is.

    Trees keep those rows and read them again for every level, a part by one task, however the
    sparse rows lay in files. The dealt rows are sparse and kept while the trees are fitted.
    """
    vector = F.unwrap_udt("features")
    width = F.max(F.coalesce(vector["size"], F.size(vector["values"])))
    about = train.agg(F.count("*").alias("rows"), width.alias("width")).first()
    size = 4 * about["rows"] * (about["width"] or 0)
    if size <= DENSE_BYTES:
        yield train
        return
    parts = max(-(-size // DENSE_BYTES), train.sparkSession.sparkContext.defaultParallelism)
    dealt = train.repartition(parts).persist()
    try:
        yield dealt
    finally:
        dealt.unpersist()


def point_is_valid(family: str, point: dict, n_classes: int) -> bool:
    """Whether a parameter point can be fitted to so many classes."""
    return not (family == "lr" and point.get("family") == "binomial" and n_classes > 2)


def fit_classifier(
    train: DataFrame, family: str, params: dict | None = None, n_classes: int | None = None
) -> Model:
    """Fit one family on ``(features, label)``; every result adds ``prediction`` to a frame."""
    params = dict(params or {})
    if family == "lr":
        return LogisticRegression(**params).fit(train)
    if family == "nb":
        model = NaiveBayes(**params)
        if params.get("modelType") != "bernoulli":
            return model.fit(train)
        # Bernoulli models are about presence and reject counts.
        presence = Binarizer(threshold=0.0, inputCol="features", outputCol="presence")
        fitted = model.setFeaturesCol("presence").fit(presence.transform(train))
        return PipelineModel(stages=[presence, fitted])
    if family == "rf":
        if params.get("cacheNodeIds"):
            ensure_checkpoint_dir(train.sparkSession)
        with dense_parts(train) as dealt:
            return RandomForestClassifier(**params).fit(dealt)
    if family == "boosted":
        if n_classes is None:
            n_classes = int(train.agg(F.max("label")).first()[0]) + 1
        return fit_boosted(train, n_classes, **params)
    raise ValueError(f"unknown family {family!r}, expected one of {FAMILIES}")
