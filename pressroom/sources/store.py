"""The article store, training frames, and the metric file."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressroom.schemas import ARTICLE_FIELDS, RSS_FIELDS, STORED_ARTICLE

# Cell texts that the usual CSV reader of Python takes for a missing value.
CSV_MISSING = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def open_store(spark: SparkSession, path: str) -> DataFrame:
    """The store with its match keys; an empty frame if nothing was stored yet."""
    try:
        return spark.read.schema(STORED_ARTICLE).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], STORED_ARTICLE)


def matching(df: DataFrame, equals: dict[str, object]) -> DataFrame:
    """Rows equal to every given field; ``None`` asks for null. An empty filter keeps all."""
    conditions = [
        F.col(f).isNull() if v is None else F.col(f) == F.lit(v) for f, v in equals.items()
    ]
    return df.where(reduce(lambda a, b: a & b, conditions)) if conditions else df


def scan_store(spark: SparkSession, path: str, equals: dict[str, object] | None = None) -> DataFrame:
    """Stored articles, filtered by equality in the Parquet scan."""
    return matching(open_store(spark, path).select(*ARTICLE_FIELDS), equals or {})


def _filled(df: DataFrame, field: str) -> Column:
    kind, value = df.schema[field].dataType, F.col(f"`{field}`")
    if isinstance(kind, T.StringType):
        return F.coalesce(value, F.lit(""))
    if isinstance(kind, T.BooleanType):
        empty = value == F.lit(False)
    elif isinstance(kind, T.NumericType):
        empty = value == 0
    elif isinstance(kind, (T.ArrayType, T.MapType)):
        empty = F.size(value) == 0
        value = F.to_json(value)
    else:
        empty = F.lit(False)
    return F.when(value.isNull() | empty, "").otherwise(value.cast("string"))


def project_fill(df: DataFrame, fields: tuple[str, ...] = RSS_FIELDS) -> DataFrame:
    """The fields in order, as strings, with every null, zero, false or empty value as ``""``.

    An absent field is an error.
    """
    missing = [f for f in fields if f not in df.columns]
    if missing:
        raise KeyError(missing[0])
    return df.select(*(_filled(df, f).alias(f) for f in fields))


def training_frame(store: DataFrame, include_search: bool = False) -> DataFrame:
    """``(text, category)`` of a mixed store.

    Search articles have neither field, so they are left out, or with ``include_search`` stand
    in with their summary and topic.
    """
    if include_search:
        store = store.select(
            F.coalesce("text", "summary").alias("text"),
            F.coalesce("category", "topic").alias("category"),
        )
    rss = store.where(F.col("text").isNotNull() | F.col("category").isNotNull())
    return project_fill(rss)


def read_training_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file with a header, as strings, without the rows that miss any value.

    Unlike ``training_frame`` this drops empty cells instead of keeping them as ``""``.
    """
    cells = (
        spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    )
    known = [
        F.when(~F.col(f"`{c}`").isin(CSV_MISSING), F.col(f"`{c}`")).alias(c) for c in cells.columns
    ]
    return cells.select(*known).dropna("any")


def write_metrics(metrics: DataFrame, path: str) -> None:
    """One CSV line ``accuracy,precision,recall,f1``, replacing the last run's."""
    (
        metrics.select("accuracy", "precision", "recall", "f1")
        .coalesce(1).write.mode("overwrite").csv(path)
    )
