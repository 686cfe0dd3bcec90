"""Concatenation of article sources. Duplicates stay."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressroom.schemas import ARTICLE_FIELDS


def union_sources(*frames: DataFrame) -> DataFrame:
    """Articles of several sources with the same fields."""
    return reduce(DataFrame.unionByName, frames)


def widen(df: DataFrame) -> DataFrame:
    """The wide nine-field shape, with nulls for the fields a source does not have."""
    return df.select(
        *(F.col(f) if f in df.columns else F.lit(None).cast("string").alias(f)
          for f in ARTICLE_FIELDS)
    )


def union_mixed(*frames: DataFrame) -> DataFrame:
    """Articles of sources with different fields, in the wide shape."""
    return reduce(DataFrame.unionByName, (widen(df) for df in frames))
