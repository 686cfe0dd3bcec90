"""Continuous prediction."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from pressroom.plans.predict import predict


def start_scoring(
    model: PipelineModel, stream: DataFrame, out_path: str, checkpoint: str,
    period: str | None = None,
) -> StreamingQuery:
    """Classify records as they arrive and append them to Parquet files, each exactly once.

    All stages of every family are plain column expressions, so they apply to a stream directly.
    """
    trigger = {"processingTime": period} if period else {"availableNow": True}
    return (
        predict(model, stream).writeStream.format("parquet")
        .option("path", out_path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
