"""Category to label and back.

A label set is as small as a classifier's class list, which every model holds in memory.
"""

from __future__ import annotations

from pyspark.ml.feature import IndexToString, StringIndexer, StringIndexerModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pressroom.session import numbered


def frequency_indexer(input_col: str = "category", output_col: str = "label") -> StringIndexer:
    """Most frequent category = 0; ties in alphabetical order."""
    return StringIndexer(inputCol=input_col, outputCol=output_col)


def alphabetical_indexer(input_col: str = "category", output_col: str = "label") -> StringIndexer:
    """Categories in sorted order, from 0."""
    return StringIndexer(inputCol=input_col, outputCol=output_col, stringOrderType="alphabetAsc")


def first_seen_ids(df: DataFrame, order_col: str, category_col: str = "category") -> DataFrame:
    """``(category, categoryId, count)`` with ids in order of first appearance by ``order_col``."""
    seen = df.groupBy(category_col).agg(
        F.min(order_col).alias("first_seen"), F.count(F.lit(1)).alias("count")
    )
    # The window runs over one row per category.
    order = Window.orderBy("first_seen", category_col)
    return seen.select(
        category_col, (F.row_number().over(order) - 1).cast("long").alias("categoryId"), "count"
    )


def label_map(df: DataFrame) -> DataFrame:
    """Distinct ``(label, category)`` of a labelled frame."""
    return df.select(F.col("label").cast("int").alias("label"), "category").distinct()


def indexer_label_map(spark: SparkSession, indexer: StringIndexerModel) -> DataFrame:
    """``(label, category)`` of a fitted indexer."""
    return numbered(spark, list(indexer.labels), "label", "category")


def lookup_category(df: DataFrame, labels: DataFrame, label_col: str = "prediction") -> DataFrame:
    """Add the category of an integer-valued label column.

    ``labels`` comes from a fitted indexer, a local table whose size the optimizer knows, so the
    join is broadcast by that size. A label that is null or not in the table has a null category.
    """
    named = labels.withColumnRenamed("label", "_label")
    return df.join(named, F.col(label_col).cast("int") == F.col("_label"), "left").drop("_label")


def category_namer(
    labels: list[str], input_col: str = "prediction", output_col: str = "predicted"
) -> IndexToString:
    """The same lookup as a pipeline stage, without a join."""
    return IndexToString(inputCol=input_col, outputCol=output_col, labels=labels)
