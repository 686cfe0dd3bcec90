"""Record shapes shared by every module."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names of the two article shapes on the topic.
RSS_FIELDS = ("text", "category")
SEARCH_FIELDS = ("title", "published_date", "link", "clean_url", "summary", "media", "topic")

ARTICLE_FIELDS = RSS_FIELDS + SEARCH_FIELDS


def strings(fields) -> T.StructType:
    """A struct of nullable strings."""
    return T.StructType([T.StructField(f, T.StringType()) for f in fields])


ARTICLE = strings(ARTICLE_FIELDS)
MESSAGE = T.ArrayType(ARTICLE)

# What a store holds on disk: the article and the keys it answers to (see operators.dedupe).
STORED_ARTICLE = T.StructType(
    ARTICLE.fields + [T.StructField("match_keys", T.ArrayType(T.BinaryType()))]
)

REQUEST_CONFIG = T.StructType(
    [
        T.StructField(
            "RapidAPI",
            T.MapType(
                T.StringType(),
                T.StructType(
                    [
                        T.StructField(
                            "api",
                            T.ArrayType(
                                T.StructType(
                                    [
                                        T.StructField("requestType", T.StringType()),
                                        T.StructField("url", T.StringType()),
                                        T.StructField(
                                            "queryString", T.MapType(T.StringType(), T.StringType())
                                        ),
                                        T.StructField(
                                            "headers", T.MapType(T.StringType(), T.StringType())
                                        ),
                                        T.StructField("APIlimit", T.IntegerType()),
                                    ]
                                )
                            ),
                        ),
                        T.StructField("MaxAPIS", T.IntegerType()),
                    ]
                ),
            ),
        )
    ]
)
