"""Search responses to seven-field articles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressroom.schemas import SEARCH_FIELDS, strings

_RECORDS = T.ArrayType(T.MapType(T.StringType(), T.StringType()))

def projected_articles(body: Column, field: str = "articles") -> Column:
    """The seven attributes of every record of a response, as ``array<struct>``.

    All or nothing: if any record lacks an attribute the response yields null. An attribute that
    is present with a null value is kept.
    """
    response = T.StructType([T.StructField(field, _RECORDS)])
    records = F.from_json(body, response)[field]

    def complete(record: Column) -> Column:
        return reduce(lambda a, b: a & b, (F.map_contains_key(record, f) for f in SEARCH_FIELDS))

    picked = F.transform(
        records,
        lambda r: F.struct(*(F.try_element_at(r, F.lit(f)).alias(f) for f in SEARCH_FIELDS)),
    )
    return F.when(F.forall(records, complete), picked).cast(T.ArrayType(strings(SEARCH_FIELDS)))


def search_groups(df: DataFrame, body_col: str, *keep: str, field: str = "articles") -> DataFrame:
    """One row per response that yields articles, holding its list; empty and null ones go."""
    # Exploding one element keeps the filter below from parsing every response a second time.
    one = F.array(projected_articles(F.col(body_col), field))
    groups = df.select(*keep, F.explode(one).alias("articles"))
    return groups.where(F.size("articles") > 0)


def search_articles(df: DataFrame, body_col: str, *keep: str, field: str = "articles") -> DataFrame:
    """One row per article of every response that yields any."""
    return df.select(*keep, F.inline(projected_articles(F.col(body_col), field)))
