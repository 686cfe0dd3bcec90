"""Sharding by weighted rendezvous hashing of stable record keys, in DataFrame functions alone.

Every shard draws a number for every key from a digest of the two; the shard with the least draw,
divided by its weight, gets the record. A shard's draws depend on nothing else, so another shard takes
records only into itself, and one that goes leaves all others' records where they are.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressroom.llm.common import let
from pressroom.session import write_and_read

#: Hex digits of a digest that make a draw; 52 bits are exact in a double.
DIGITS = 13
#: Shards of the registered query.
SHARDS = 8


def even(shards: int) -> dict[int, float]:
    """Shards 0 to ``shards`` - 1 of equal weight."""
    return {shard: 1.0 for shard in range(shards)}


def _draws(key: Column, weights: Mapping[int, float]) -> Column:
    """An array of (draw, shard): the exponential variable of the key and each shard, over its weight."""
    if not weights or any(not w > 0 for w in weights.values()):
        raise ValueError("at least one shard, and weights above 0")
    name = F.coalesce(F.concat(F.lit("k"), key.cast("string")), F.lit("n"))

    def draw(text: Column, shard: int) -> Column:
        digest = F.substring(F.md5(F.concat(text, F.lit(f"/{shard}"))), 1, DIGITS)
        unit = (F.conv(digest, 16, 10).cast("double") + 0.5) / float(16 ** DIGITS)
        return -F.log(unit) / float(weights[shard])

    return let(name, lambda text: F.array(*(
        F.struct(draw(text, s).alias("draw"), F.lit(s).alias("shard")) for s in sorted(weights))))


def shard_of(key: Column, weights: Mapping[int, float]) -> Column:
    """The shard of a key: int, by the key and the shards' weights alone. Null is a key like others."""
    return F.array_min(_draws(key, weights))["shard"]


def place(
    df: DataFrame, key: str, weights: Mapping[int, float], grown: Mapping[int, float] | None = None,
) -> DataFrame:
    """``df`` with ``shard`` and, if ``grown`` is given, ``grown_shard``: its place among those shards.

    ``grown`` holds all of ``weights`` and more; as draws are shared, a row's two places differ only
    where one of the added shards takes it. Map only; columns of those names are replaced. Rows of one
    key, null among them, go together; an empty table stays empty.
    """
    if grown is None:
        return df.withColumn("shard", shard_of(F.col(key), weights))
    if any(grown.get(s) != w for s, w in weights.items()):
        raise ValueError("grown shards must include all others at their weights")
    known = F.array(*(F.lit(s) for s in sorted(weights)))
    both = let(_draws(F.col(key), grown), lambda draws: F.struct(
        F.array_min(F.filter(draws, lambda d: F.array_contains(known, d["shard"])))["shard"].alias("now"),
        F.array_min(draws)["shard"].alias("later")))
    return (df.withColumn("_places", both).withColumn("shard", F.col("_places.now"))
            .withColumn("grown_shard", F.col("_places.later")).drop("_places"))


def number(placed: DataFrame, order: list[str]) -> DataFrame:
    """``placed`` with ``slot``: the row's number in its shard, gapless from 0, by ``order``, nulls first.

    Rows are dealt into ranges of (shard, order), with a row's own number last, so that no number of
    equal rows needs one task. A row's slot is its place in its range plus the rows of its shard in
    earlier ranges; ranges' counts are one row for each shard and range, which bounds what is
    broadcast by the number of tasks. Rows that tie in ``order`` are numbered as they were written. A
    column named ``slot`` is replaced; repeated rows get slots of their own.
    """
    kept = [c for c in placed.columns if c != "slot"]
    rows = write_and_read(
        placed.select(*kept, F.monotonically_increasing_id().alias("_at")), "shard-rows")
    by = ["shard", *order, "_at"]
    dealt = rows.repartitionByRange(*(F.col(c) for c in by)).sortWithinPartitions(*by)
    place_in_range = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranges = write_and_read(
        dealt.select(*kept, F.spark_partition_id().alias("_range"), place_in_range.alias("_row")),
        "shard-ranges")
    counts = ranges.groupBy("shard", "_range").agg(
        F.count("*").alias("_n"), F.min("_row").alias("_first"))
    earlier = Window.partitionBy("shard").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "shard", "_range", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_start"))
    return ranges.join(F.broadcast(starts), ["shard", "_range"]).select(
        *kept, (F.col("_row") + F.col("_start")).alias("slot"))


def write_shards(df: DataFrame, path: str, key: str, weights: Mapping[int, float]) -> None:
    """``df`` with ``shard`` and ``slot`` as Parquet under ``path``, a folder per shard, by key inside.

    A shard's files hold consecutive slots, so that a reader of some shards opens no other's files.
    """
    number(place(df, key, weights), [key]).write.partitionBy("shard").parquet(path)


def growth(placed: DataFrame) -> DataFrame:
    """``shard, grown_shard, rows``: what stays and what moves, counted before the shuffle."""
    return placed.groupBy("shard", "grown_shard").agg(F.count("*").alias("rows"))


def shard_query(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    measured = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    placed = place(measured, "doc_id", even(SHARDS), even(SHARDS + 1))
    return number(placed, ["doc_id", "size", "text_crc32"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


# crc32 in DuckDB: the table of its 256 remainders is computed, then folded over the UTF-8 bytes.
SHARDS_SQL = f"""
WITH RECURSIVE step AS (
  SELECT 0 AS n, i, i AS c FROM range(256) t(i)
  UNION ALL
  SELECT n + 1, i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM step WHERE n < 8
), remainders AS (SELECT list(c ORDER BY i) AS t FROM step WHERE n = 8
), d AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS b FROM documents
), sized AS (
  SELECT row, doc_id, strlen(b) + 1 AS size,
    xor(list_reduce(
      list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(b)), '..'), lambda x: ('0x' || x)::BIGINT)),
      lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS text_crc32
  FROM d, remainders
), drawn AS (
  SELECT row, s, -ln((('0x' || md5(coalesce('k' || doc_id::VARCHAR, 'n') || '/' || s)[1:{DIGITS}])::BIGINT + 0.5)
    / {16 ** DIGITS}::DOUBLE) AS draw
  FROM d, range({SHARDS + 1}) t(s)
), placed AS (
  SELECT row, arg_min(s, draw) FILTER (s < {SHARDS}) AS shard, arg_min(s, draw) AS grown_shard
  FROM drawn GROUP BY row
)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard::INT AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, size, text_crc32, row) - 1 AS slot,
  grown_shard::INT AS grown_shard
FROM sized JOIN placed USING (row)
"""
