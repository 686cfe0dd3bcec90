"""Classification metrics, all from one aggregate of (label, prediction) counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def confusion(predictions: DataFrame, label_col: str = "label",
              prediction_col: str = "prediction") -> DataFrame:
    """``(label, prediction, n)``. Everything else here works on these few rows."""
    return predictions.groupBy(
        F.col(label_col).alias("label"), F.col(prediction_col).alias("prediction")
    ).agg(F.count(F.lit(1)).alias("n"))


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def class_scores(counts: DataFrame, *by: str) -> DataFrame:
    """``(…by, class, precision, recall, f1, support)`` of every class seen or predicted."""
    hit = F.col("label") == F.col("prediction")
    as_label = counts.select(
        *by,
        F.col("label").alias("class"), F.when(hit, F.col("n")).otherwise(0).alias("tp"),
        F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted"),
    )
    as_prediction = counts.select(
        *by,
        F.col("prediction").alias("class"), F.lit(0).cast("long").alias("tp"),
        F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted"),
    )
    sums = as_label.unionByName(as_prediction).groupBy(*by, "class").agg(
        F.sum("tp").alias("tp"), F.sum("support").alias("support"),
        F.sum("predicted").alias("predicted"),
    )
    return sums.select(
        *by, "class", "support", "predicted",
        _ratio(F.col("tp"), F.col("predicted")).alias("precision"),
        _ratio(F.col("tp"), F.col("support")).alias("recall"),
        _ratio(2 * F.col("tp"), F.col("predicted") + F.col("support")).alias("f1"),
        "tp",
    )


def weighted_metrics(counts: DataFrame, *by: str) -> DataFrame:
    """``(accuracy, precision, recall, f1)``, the last three weighted by support: one row, or one for each ``by``."""
    total = F.sum("support")

    def weighted(c: str) -> Column:
        return _ratio(F.sum(F.col(c) * F.col("support")), total)

    return class_scores(counts, *by).groupBy(*by).agg(
        _ratio(F.sum("tp"), total).alias("accuracy"),
        weighted("precision").alias("precision"),
        weighted("recall").alias("recall"),
        weighted("f1").alias("f1"),
    )


def accuracy(predictions: DataFrame, label_col: str = "label",
             prediction_col: str = "prediction") -> DataFrame:
    """One row: the share of exact matches."""
    hit = (F.col(label_col) == F.col(prediction_col)).cast("double")
    return predictions.agg(F.avg(hit).alias("accuracy"))


def classification_report(counts: DataFrame) -> DataFrame:
    """Per class, then ``accuracy``, ``macro avg`` and ``weighted avg``, in one frame.

    In the accuracy row all three scores are the accuracy.
    """
    per_class = class_scores(counts)
    scores = ("precision", "recall", "f1")
    total = F.sum("support")
    averages = per_class.agg(
        *(F.avg(s).alias(f"macro_{s}") for s in scores),
        *(_ratio(F.sum(F.col(s) * F.col("support")), total).alias(f"weighted_{s}") for s in scores),
        _ratio(F.sum("tp"), total).alias("accuracy"),
        total.alias("support"),
    )
    summary = averages.select(
        F.inline(
            F.array(
                F.struct(F.lit("accuracy").alias("class"),
                         *(F.col("accuracy").alias(s) for s in scores), "support"),
                *(
                    F.struct(F.lit(f"{kind} avg").alias("class"),
                             *(F.col(f"{kind}_{s}").alias(s) for s in scores), "support")
                    for kind in ("macro", "weighted")
                ),
            )
        )
    )
    named = per_class.select(F.col("class").cast("string").alias("class"), *scores, "support")
    return named.unionByName(summary)


def metric_rows(model: str, metrics: DataFrame) -> DataFrame:
    """``(model, metric, value)`` of a one-row metric frame."""
    names = metrics.columns
    pairs = F.array(*(F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in names))
    return metrics.select(F.lit(model).alias("model"), F.inline(pairs))


def leaderboard(metrics: dict[str, DataFrame], score: str = "accuracy") -> DataFrame:
    """One score per model, best first."""
    rows = [m.select(F.lit(name).alias("model"), F.col(score).alias("score"))
            for name, m in metrics.items()]
    return reduce(DataFrame.unionByName, rows).orderBy(F.desc("score"), "model")
