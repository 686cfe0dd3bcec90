"""Categories for unlabelled text."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with ``prediction`` (label) and ``predicted`` (category) of its ``text``.

    Columns of those two names are replaced. All others are carried apart from the model's working
    columns, whatever their names.
    """
    kept = [c for c in df.columns if c not in ("prediction", "predicted")]
    scored = model.transform(df.select(F.struct(*kept).alias("_row"), "text"))
    return scored.select("_row.*", "prediction", "predicted")


def predict_text(spark: SparkSession, model: PipelineModel, text: str) -> str:
    """The category of one text."""
    one = spark.createDataFrame([(text,)], "text string")
    return predict(model, one).first()["predicted"]
