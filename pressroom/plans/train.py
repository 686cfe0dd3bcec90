"""The training job, and saving and loading what it makes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressroom.operators.evaluate import confusion, weighted_metrics
from pressroom.operators.labels import category_namer
from pressroom.operators.split import MAIN_SPLIT, hash_fold, hash_split
from pressroom.plans.features import count_pipeline, label_pipeline
from pressroom.plans.models import MAIN_PARAMS, fit_classifier
from pressroom.session import numbered
from pressroom.sources.store import scan_store, training_frame, write_metrics


@dataclass
class Prepared:
    """Fitted text stages, the class names in label order, and the two parts of the data.

    ``train`` and ``test`` are ``(features, label)`` views of ``featurized``, which is persisted.
    """

    text_model: PipelineModel
    labels: list[str]
    featurized: DataFrame
    train: DataFrame
    test: DataFrame


@dataclass
class Trained:
    """A model from text to category with its scores on the held-out part."""

    model: PipelineModel
    labels: list[str]
    counts: DataFrame
    metrics: DataFrame


def prepare(
    df: DataFrame,
    features: Pipeline | None = None,
    split: tuple[list[float], int] = MAIN_SPLIT,
    key: str | None = None,
    fit_on: str = "all",
    label_order: str = "frequency",
    folds: int | None = None,
) -> Prepared:
    """Featurize ``(text, category)`` once and split it.

    ``fit_on="all"`` fits vocabulary and weights on every row, test rows too; ``"train"`` leaves
    the test rows out. ``key`` names a column whose hash decides the split. Fits and scores read the features again and
    again, so they are persisted until ``release``.

    Without a key the text itself decides: every copy of a text is on the same side, and a recomputed
    row is where it was before. ``folds`` adds a column ``fold`` from the same key.
    """
    if fit_on not in ("all", "train"):
        raise ValueError(f"fit_on must be 'all' or 'train', not {fit_on!r}")
    if key is None:
        key = "_text_key"
        df = df.withColumn(key, F.md5(F.coalesce("text", F.lit(""))))
    seen = hash_split(df, key, split[0])[0] if fit_on == "train" else df
    text_model = (features or count_pipeline()).fit(seen.select("text"))
    indexer = label_pipeline(label_order).fit(df.select("category"))
    stages = PipelineModel(stages=[*text_model.stages, *indexer.stages])
    columns = ["features", "label", *(["fold"] if folds else [])]
    fold = [hash_fold(F.col(key), folds).alias("fold")] if folds else []
    featurized = stages.transform(df).select("features", "label", *fold, key).persist()
    train, test = (p.select(*columns) for p in hash_split(featurized, key, split[0]))
    return Prepared(text_model, list(indexer.stages[0].labels), featurized, train, test)


def release(prepared: Prepared) -> None:
    prepared.featurized.unpersist()


def local_counts(predictions: DataFrame) -> DataFrame:
    """The confusion counts as a local table: classes squared rows, computed once."""
    counts = confusion(predictions)
    rows = counts.collect()
    return predictions.sparkSession.createDataFrame(rows, counts.schema)


def assemble(prepared: Prepared, classifier) -> PipelineModel:
    """Text stages, classifier and category name in one model that can be saved and streamed."""
    return PipelineModel(
        stages=[*prepared.text_model.stages, classifier, category_namer(prepared.labels)]
    )


def train(
    df: DataFrame,
    family: str = "lr",
    params: dict | None = None,
    **prepare_options,
) -> Trained:
    """Train one family on ``(text, category)``; logistic regression as configured by default."""
    if params is None and family == "lr":
        params = MAIN_PARAMS
    prepared = prepare(df, **prepare_options)
    try:
        classifier = fit_classifier(prepared.train, family, params, len(prepared.labels))
        counts = local_counts(classifier.transform(prepared.test))
    finally:
        release(prepared)
    return Trained(assemble(prepared, classifier), prepared.labels, counts, weighted_metrics(counts))


def save(trained: Trained, path: str) -> None:
    """Write the model and its label map; an existing model at the path is replaced."""
    spark = trained.counts.sparkSession
    trained.model.write().overwrite().save(f"{path}/model")
    labels = numbered(spark, trained.labels, "label", "category")
    labels.coalesce(1).write.mode("overwrite").parquet(f"{path}/labels")


def load(spark: SparkSession, path: str) -> tuple[PipelineModel, DataFrame]:
    """The saved model and its ``(label, category)`` map."""
    labels = spark.read.schema("label int, category string").parquet(f"{path}/labels")
    return PipelineModel.load(f"{path}/model"), labels.select(F.col("label"), "category")


def train_from_store(
    spark: SparkSession,
    store_path: str,
    model_path: str,
    metrics_path: str,
    family: str = "lr",
    params: dict | None = None,
    include_search: bool = False,
    **prepare_options,
) -> Trained:
    """The whole training job: stored articles in, saved model and metric line out."""
    articles = training_frame(scan_store(spark, store_path), include_search)
    trained = train(articles, family, params, **prepare_options)
    save(trained, model_path)
    write_metrics(trained.metrics, metrics_path)
    return trained
