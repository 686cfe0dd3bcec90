"""Counts per category."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pressroom.operators.labels import first_seen_ids


def category_profile(df: DataFrame, order_col: str) -> DataFrame:
    """Rows per ``(category, categoryId)``, ids in order of first appearance.

    Ids and counts come from the same aggregate, so the rows are read and shuffled once.
    """
    return first_seen_ids(df, order_col)


def category_ids(df: DataFrame, order_col: str) -> DataFrame:
    """Distinct ``(category, categoryId)`` in id order."""
    return first_seen_ids(df, order_col).select("category", "categoryId").orderBy("categoryId")
