"""Plans of what to fetch: hits per configured API, and archive months."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressroom.schemas import REQUEST_CONFIG

# The configured requests.
REQUEST_URL = "https://real-time-news-data.p.rapidapi.com/topic-headlines"
REQUEST_HOST = "real-time-news-data.p.rapidapi.com"
REQUEST_TOPICS = [
    "TECHNOLOGY", "BUSINESS", "TECHNOLOGY", "WORLD", "ENTERTAINMENT", "SPORTS", "SCIENCE", "HEALTH",
]
REQUEST_LIMIT = {"SPORTS": 50}
MAX_REQUESTS = 50

# Where an archive month is fetched from and landed.
ARCHIVE_URL = "https://api.nytimes.com/svc/archive/v1/{}/{}.json"
ARCHIVE_KEY = "api-key"
ARCHIVE_FILE = "./Data/NYTimeData/{}-{}.json"


def _fill(template: str, *values: Column) -> Column:
    """The template with its ``{}`` replaced. Plain concatenation stays in generated code."""
    first, *rest = template.split("{}")
    parts = [F.lit(first)]
    for value, text in zip(values, rest):
        parts += [value.cast("string"), F.lit(text)]
    return F.concat(*parts)


def request_config(api_key: str = "") -> str:
    """The configured requests as JSON."""
    apis = []
    for topic in REQUEST_TOPICS:
        api = {
            "requestType": "GET",
            "url": REQUEST_URL,
            "queryString": {"topic": topic, "country": "US", "lang": "en"},
            "headers": {"X-RapidAPI-Key": api_key, "X-RapidAPI-Host": REQUEST_HOST},
        }
        if topic in REQUEST_LIMIT:
            api["APIlimit"] = REQUEST_LIMIT[topic]
        apis.append(api)
    return json.dumps({"RapidAPI": {"1": {"api": apis, "MaxAPIS": MAX_REQUESTS}}})


def read_request_config(spark: SparkSession, path: str) -> DataFrame:
    """``(body)`` of configuration files, one whole file per row."""
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", "body")


def request_plan(df: DataFrame, body_col: str, *keep: str) -> DataFrame:
    """Every request to send: the allowance of a key is shared out evenly over its APIs.

    A row has all that a request needs but the secrets: its address and query parameters, the names
    of its headers, and the limit of its API. Header values are looked up by name when it is sent.
    APIs count from 1 and hits from 0; a share below one, or a key without
    APIs, gives no request.
    """
    parsed = F.from_json(F.col(body_col), REQUEST_CONFIG)["RapidAPI"]
    per_key = df.select(*keep, F.explode(parsed).alias("config_key", "config")).select(
        *keep,
        "config_key",
        F.expr("config.MaxAPIS div nullif(size(config.api), 0)").alias("hits"),
        F.col("config.api").alias("apis"),
    )
    # A descending sequence would come out of hits = 0, so those keys go first.
    per_api = per_key.where("hits > 0").select(
        *keep, "config_key", "hits", F.posexplode("apis").alias("api_pos", "api")
    )
    return per_api.select(
        *keep,
        "config_key",
        (F.col("api_pos") + 1).alias("api_index"),
        F.explode(F.expr("sequence(0L, hits - 1)")).alias("hit"),
        F.col("api.requestType").alias("request_type"),
        F.col("api.url").alias("url"),
        F.col("api.queryString").alias("query_string"),
        F.map_keys("api.headers").alias("header_names"),
        F.col("api.APIlimit").alias("api_limit"),
    ).withColumn("output_name", _fill("{}-{}.json", F.col("api_index"), F.col("hit")))


def signed(url: str, api_key: str) -> str:
    """The address to send an archive request to. Keys never enter a table."""
    return f"{url}?{ARCHIVE_KEY}={api_key}"


def with_archive_keys(df: DataFrame, path_col: str) -> DataFrame:
    """Year, month, request URL and landing file of archive paths like ``…/2019-7.json``.

    ``archive_ok`` is false, and the keys null, where the file name is not exactly two parts.
    """
    stem = F.split_part(F.element_at(F.split(F.col(path_col), "/"), -1), F.lit("."), F.lit(1))
    parts = F.split(stem, "-")
    ok = F.coalesce(F.size(parts) == 2, F.lit(False))
    year, month = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    return df.select(
        "*",
        ok.alias("archive_ok"),
        F.when(ok, year).alias("year"),
        F.when(ok, month).alias("month"),
        F.when(ok, _fill(ARCHIVE_URL, year, month)).alias("request_url"),
        F.when(ok, _fill(ARCHIVE_FILE, year, month)).alias("output_name"),
    )


def archive_keys(df: DataFrame, path_col: str) -> DataFrame:
    """The well-formed archive paths."""
    return with_archive_keys(df, path_col).where("archive_ok").drop("archive_ok")


def archive_quarantine(df: DataFrame, path_col: str) -> DataFrame:
    """The paths that do not name a month."""
    return with_archive_keys(df, path_col).where("NOT archive_ok").select(*df.columns)
