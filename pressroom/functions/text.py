"""Scalar functions on article text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compose_text(title: Column, description: Column) -> Column:
    """Title and description with no separator; null if either is missing."""
    return F.concat(title, description)


def strip_markup(text: Column) -> Column:
    """Drop every ``<`` up to the next ``>``. Stray ``>`` and entities stay."""
    return F.regexp_replace(text, "<[^>]*>", "")


def has_unclosed_tag(text: Column) -> Column:
    """True where a ``<`` never meets its ``>``: one follows the last ``>`` of the text."""
    return F.contains(F.substring_index(text, ">", -1), F.lit("<"))


def with_clean_text(df: DataFrame, text_col: str, output_col: str | None = None) -> DataFrame:
    """Strip markup and leave out rows with an unclosed tag (or null text)."""
    text = F.col(text_col)
    return df.where(~has_unclosed_tag(text)).withColumn(output_col or text_col, strip_markup(text))


def lower_text(text: Column) -> Column:
    return F.lower(text)
