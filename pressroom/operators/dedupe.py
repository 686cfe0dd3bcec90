"""Insert-if-absent.

An incoming article is already known if a stored one equals it on all the fields the incoming one
has, whatever else the stored one has. So a stored row *answers to* up to three keys: its RSS
fields, its search fields, and, if it has both, all nine. An incoming row *asks for* one key. Keys
are SHA-256 digests of the fields, nulls included, so matching is null-safe and reads 32 bytes per
stored article instead of its text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressroom.operators.combine import widen
from pressroom.schemas import ARTICLE_FIELDS, RSS_FIELDS, SEARCH_FIELDS, STORED_ARTICLE
from pressroom.sources.store import open_store


def _has_any(fields) -> Column:
    return reduce(lambda a, b: a | b, (F.col(f).isNotNull() for f in fields))


def _key(fields) -> Column:
    # JSON with explicit nulls and field names: different shapes or values never read the same.
    return F.unhex(F.sha2(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), 256))


def with_match_keys(articles: DataFrame) -> DataFrame:
    """Articles in the wide shape with ``asks`` (one key) and ``match_keys``.

    Rows without any field set are left out. Keys are made in the scan; nothing is shuffled.
    """
    rows = widen(articles).where(_has_any(ARTICLE_FIELDS))
    rss, search = _has_any(RSS_FIELDS), _has_any(SEARCH_FIELDS)
    keys = F.array_compact(
        F.array(
            F.when(rss & search, _key(ARTICLE_FIELDS)),
            F.when(rss, _key(RSS_FIELDS)),
            F.when(search, _key(SEARCH_FIELDS)),
        )
    )
    # The widest key comes first, and is the one the row asks for.
    return rows.withColumn("match_keys", keys).withColumn("asks", F.get("match_keys", F.lit(0)))


def fresh_keys(rows: DataFrame, store: DataFrame) -> DataFrame:
    """The distinct keys asked by ``with_match_keys`` rows that no article answers to yet.

    Within a batch, articles with both shapes count as stored before the narrower ones. Only keys
    move: copies collapse before the shuffle, and the stored keys are filtered to the asked ones.
    """
    keys = rows.select("asks", "match_keys").distinct()
    asked = keys.select("asks")
    stored = store.select(F.explode("match_keys").alias("asks")).join(asked, "asks", "left_semi")
    wider = keys.where(F.size("match_keys") > 1).select(
        F.explode(F.slice("match_keys", 2, 2)).alias("asks")
    )
    return asked.join(stored.unionByName(wider), "asks", "left_anti")


def unseen(rows: DataFrame, fresh: DataFrame) -> DataFrame:
    """One row for each fresh key, ready to append. Rows that ask for the same key are equal."""
    survivors = rows.join(fresh, "asks", "left_semi")
    return survivors.dropDuplicates(["asks"]).select(*STORED_ARTICLE.fieldNames())


def append_unseen(articles: DataFrame, store_path: str) -> None:
    """Append the unknown articles of a batch to the store at ``store_path``.

    A replayed batch adds nothing, so a batch whose write failed can simply run again. One writer
    per store: two concurrent batches could both find an article absent. Errors are raised.
    """
    store = open_store(articles.sparkSession, store_path)
    # Once computed, the fresh keys have a size: few of them are broadcast to the rows, whose texts
    # then stay where they are; only texts that will be written are ever shuffled.
    rows = with_match_keys(articles).persist()
    fresh = fresh_keys(rows, store).persist()
    try:
        if fresh.count():
            unseen(rows, fresh).write.mode("append").parquet(store_path)
    finally:
        fresh.unpersist()
        rows.unpersist()
