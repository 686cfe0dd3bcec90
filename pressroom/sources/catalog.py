"""Feed catalogs: which URLs carry which category."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The feeds to read, per publisher. A category holds one URL or a list of them.
CNN = {
    "business": "http://rss.cnn.com/rss/money_latest.rss",
    "politics": "http://rss.cnn.com/rss/cnn_allpolitics.rss",
    "tech": "http://rss.cnn.com/rss/cnn_tech.rss",
    "health": "http://rss.cnn.com/rss/cnn_health.rss",
    "entertainment": "http://rss.cnn.com/rss/cnn_showbiz.rss",
}
NEW_YORK_TIMES = {
    "world": "https://rss.nytimes.com/services/xml/rss/nyt/World.xml",
    "business": "https://rss.nytimes.com/services/xml/rss/nyt/Business.xml",
    "politics": "https://rss.nytimes.com/services/xml/rss/nyt/Politics.xml",
    "tech": "https://rss.nytimes.com/services/xml/rss/nyt/Technology.xml",
    "health": "https://rss.nytimes.com/services/xml/rss/nyt/Health.xml",
    "entertainment": [
        "https://rss.nytimes.com/services/xml/rss/nyt/Movies.xml",
        "https://rss.nytimes.com/services/xml/rss/nyt/Music.xml",
        "https://rss.nytimes.com/services/xml/rss/nyt/Television.xml",
        "https://rss.nytimes.com/services/xml/rss/nyt/Theater.xml",
    ],
    "sports": "https://rss.nytimes.com/services/xml/rss/nyt/Sports.xml",
    "science": "https://rss.nytimes.com/services/xml/rss/nyt/Science.xml",
}
REUTERS = {
    "business": "https://www.reutersagency.com/feed/?best-topics=business-finance&post_type=best",
    "politics": "https://www.reutersagency.com/feed/?best-topics=political-general&post_type=best",
    "tech": "https://www.reutersagency.com/feed/?best-topics=tech&post_type=best",
    "health": "https://www.reutersagency.com/feed/?best-topics=health&post_type=best",
    "entertainment": "https://www.reutersagency.com/feed/?best-topics=lifestyle-entertainment&post_type=best",
    "sports": "https://www.reutersagency.com/feed/?best-topics=sports&post_type=best",
}
GUARDIAN = {
    "world": "https://www.theguardian.com/world/rss",
    "sports": "https://www.theguardian.com/uk/sport/rss",
    "tech": "https://www.theguardian.com/uk/technology/rss",
    "science": "https://www.theguardian.com/science/rss",
    "entertainment": [
        "https://www.theguardian.com/music/rss",
        "https://www.theguardian.com/us/film/rss",
        "https://www.theguardian.com/games/rss",
    ],
}
# The order in which the publishers are read.
PUBLISHERS = {
    "cnn": CNN,
    "new_york_times": NEW_YORK_TIMES,
    "reuters": REUTERS,
    "guardian": GUARDIAN,
}
# The searches that follow the feeds.
SEARCH_QUERIES = [
    "Bitcoin", "Harry Potter", "Egyptian Pyramids", "Fifa", "Engineering", "Bank Robbery",
]


def catalog_frame(spark: SparkSession, catalog: dict[str, str | list[str]]) -> DataFrame:
    """``(category, urls)`` of a catalog given as a dict."""
    rows = [(c, [u] if isinstance(u, str) else list(u)) for c, u in catalog.items()]
    return spark.createDataFrame(rows, "category string, urls array<string>")


def url_list(value: Column) -> Column:
    """A JSON value that is one URL or a list of URLs, as an array."""
    return F.when(
        value.startswith("["), F.from_json(value, T.ArrayType(T.StringType()))
    ).otherwise(F.array(value))


def parse_catalog(df: DataFrame, json_col: str, *keep: str) -> DataFrame:
    """``(category, urls)`` of catalogs given as JSON objects, one per row."""
    parsed = F.from_json(json_col, T.MapType(T.StringType(), T.StringType()))
    return df.select(*keep, F.explode(parsed).alias("category", "value")).select(
        *keep, "category", url_list(F.col("value")).alias("urls")
    )


def flatten_catalog(df: DataFrame) -> DataFrame:
    """One row per (category, url), with the URL's place in its list."""
    rest = [c for c in df.columns if c != "urls"]
    # The outer form infers no filter that would parse the list a second time.
    urls = df.select(*rest, F.posexplode_outer("urls").alias("position", "url"))
    return urls.where("position IS NOT NULL")
