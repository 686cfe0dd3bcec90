"""What several operators share: the word pattern, folds, let-binding and written tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressroom.session import scratch_path

#: Characters that separate words: space and the ASCII controls tab to carriage return.
SPACES = " \t\n\x0b\f\r"
#: A word, as a pattern for Spark, Python and DuckDB alike.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``: the same on every engine and in every run."""
    return F.crc32(key.cast("string")) % F.lit(folds)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often the body names it.

    A lambda over a one-element array binds the value; a plain column expression would be
    computed again for every element of an inner lambda.
    """
    return F.transform(F.array(value), body)[0]


def written_by(df: DataFrame, name: str, column: str) -> DataFrame:
    """``df`` written to the scratch folder, one folder per value of ``column``, and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.partitionBy(column).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
