"""RSS bodies to ``(text, category)`` articles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressroom.functions.text import compose_text, with_clean_text
from pressroom.operators.combine import union_sources

# Arrays, because an item may repeat a tag (the first counts) and because an array tells an
# empty tag from a missing one.
_ITEM = T.StructType(
    [
        T.StructField("title", T.ArrayType(T.StringType())),
        T.StructField("description", T.ArrayType(T.StringType())),
    ]
)
# One item with its tag; what looks like its end inside a CDATA section isn't. Possessive, so that a
# long item needs no deep recursion.
_ITEM_TEXT = (
    r"(?is)<item(?:\s[^>]*+)?(?<!/)>[^<]*+"
    r"(?:<(?!/item\s*>)(?:!\[CDATA\[.*?\]\]>)?[^<]*+)*+</item\s*>")

# Blanks around a title or description are part of the text.
_XML = {"ignoreSurroundingSpaces": "false"}


def _first(tag: str) -> Column:
    return F.when(F.size(tag) > 0, F.coalesce(F.get(F.col(tag), F.lit(0)), F.lit("")))


def _articles(items: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """Items with a title and a description, joined and stripped; the others are left out."""
    composed = items.select(
        *keep, compose_text(_first("title"), _first("description")).alias("text")
    ).where(F.col("text").isNotNull())
    return with_clean_text(composed, "text")


def feed_articles(df: DataFrame, body_col: str, *keep: str) -> DataFrame:
    """Articles of whole feed documents held in a column.

    Items count wherever they stand: in one channel or several, beside it, or deeper. Each is parsed
    on its own, so a malformed one costs itself alone.
    """
    found = F.regexp_extract_all(F.col(body_col), F.lit(_ITEM_TEXT), F.lit(0))
    parsed = F.transform(found, lambda item: F.from_xml(item, _ITEM, _XML))
    return _articles(df.select(*keep, F.inline(parsed)), keep)


def rejected_feeds(df: DataFrame, body_col: str, *keep: str) -> DataFrame:
    """``(…keep, item, reason)`` of feed documents without an item, and of items that don't parse."""
    found = F.regexp_extract_all(F.col(body_col), F.lit(_ITEM_TEXT), F.lit(0))
    none = F.array(F.struct(F.lit(None).cast("string").alias("item"), F.lit("no item").alias("reason")))
    marked = T.StructType([*_ITEM.fields, T.StructField("_corrupt_record", T.StringType())])
    judged = F.transform(found, lambda item: F.struct(
        item.alias("item"),
        F.when(F.from_xml(item, marked, _XML)["_corrupt_record"].isNotNull(), "malformed").alias("reason")))
    rejects = F.when(F.coalesce(F.size(found), F.lit(0)) > 0, judged).otherwise(none)
    return df.select(*keep, F.inline(rejects)).where("reason IS NOT NULL")


def read_feed_files(spark: SparkSession, paths: str | list[str], category: str) -> DataFrame:
    """Articles of landed feed files, all of one category."""
    items = spark.read.format("xml").options(rowTag="item", **_XML).schema(_ITEM).load(paths)
    return _articles(items, ()).withColumn("category", F.lit(category))


def read_feed_catalog(spark: SparkSession, landed: dict[str, list[str]]) -> DataFrame:
    """Articles of every category's landed files; ``landed`` maps a category to its files."""
    return union_sources(*(read_feed_files(spark, files, c) for c, files in landed.items()))
