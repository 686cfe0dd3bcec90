"""A store whose batches appear whole, with an index of keys and a manifest of files.

One batch has articles, rejected messages, keys and key filters. Each attempt at it writes them under a
name of its own, and then one record in the ledger, in one file. What no record names isn't there, so a
batch that fails anywhere leaves nothing to be seen, and runs again as if for the first time.

Keys lie by their first bits, in as many prefixes as an attempt's keys fill, and each prefix has bits that
tell most keys it can't hold. A batch opens only the prefixes that may hold one of its keys. The record
also lists the attempt's files with their bytes and their range of categories, so that a scan by category
opens only files that may hold it. Compaction rewrites small attempts as one, in the order of the
categories, and replaces them by one record; readers that began before still find what they listed.

    root/articles/<attempt>  rejects/<attempt>  keys/<attempt>/prefix=<p>  filters/<attempt>  ledger/<attempt>

One writer per store: a batch or a compaction at a time. Readers are free.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressroom.operators.dedupe import fresh_keys, unseen, with_match_keys
from pressroom.schemas import ARTICLE_FIELDS, STORED_ARTICLE
from pressroom.session import write_and_read
from pressroom.sources.messages import decode_messages, rejected_messages
from pressroom.sources.store import matching

#: Bits of one filter, as the library's bitmaps have them, and bits of filters for each key.
FILTER_BITS, BITS_PER_KEY = 1 << 15, 8
#: An attempt has a prefix for about so many keys, and at most so many prefixes, whose files then grow.
KEYS_PER_PREFIX, PREFIXES = 4096, 256
#: Attempts with fewer bytes of articles are small, and compaction makes files of about so many.
FILE_BYTES = 1 << 27

#: A row for each attempt (``name`` null), and one for each of its files of articles.
LEDGER = ("attempt string, source string, batch long, replaces array<string>, prefixes int, buckets int, "
          "name string, bytes long, rows long, low string, high string, nulls boolean")
_FILTER = "prefix int, bucket int, prefixes int, buckets int, attempt string, bits binary"
_REJECT = "value string, reason string"


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    """All records; an empty frame before the first batch."""
    try:
        return spark.read.schema(LEDGER).parquet(f"{root}/ledger/*")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def _live(ledger: DataFrame) -> DataFrame:
    """The records of attempts that no other replaces."""
    gone = ledger.where("name IS NULL").select(F.explode("replaces").alias("attempt"))
    return ledger.join(gone, "attempt", "left_anti")


def _attempts(ledger: DataFrame) -> list:
    """Live attempts, their bytes and how their keys lie: a row for each batch since the last compaction."""
    return _live(ledger).groupBy("attempt").agg(
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.max("prefixes").alias("prefixes"),
        F.max("buckets").alias("buckets")).orderBy("attempt").collect()


# --- keys -------------------------------------------------------------------------------------


def _number(key: Column, start: int, size: int) -> Column:
    return F.conv(F.hex(F.substring(key, start, size)), 16, 10).cast("long")


def _prefix(key: Column, prefixes: Column) -> Column:
    return F.floor(_number(key, 1, 2) * prefixes / (1 << 16)).cast("int")


def _bit(key: Column) -> Column:
    return (_number(key, 3, 6) % FILTER_BITS).cast("int")


def _bucket(key: Column, buckets: Column) -> Column:
    """Which filter of its prefix has the key's bit."""
    return (F.floor(_number(key, 3, 6) / FILTER_BITS) % buckets).cast("int")


def _power(least: float, most: int | None = None) -> int:
    """The least power of two that is not below ``least``, but at most ``most``."""
    power = 1
    while power < least and power != most:
        power *= 2
    return power


def _write_keys(spark: SparkSession, root: str, attempt: str) -> tuple[int, int]:
    """Keys and filters of an attempt's articles; the number of prefixes, and of filters in each."""
    stored = spark.read.schema(STORED_ARTICLE).parquet(f"{root}/articles/{attempt}")
    n = stored.agg(F.coalesce(F.sum(F.size("match_keys")), F.lit(0))).first()[0]
    prefixes = _power(n / KEYS_PER_PREFIX, PREFIXES)
    buckets = _power(n * BITS_PER_KEY / (FILTER_BITS * prefixes))
    keys = stored.select(F.explode("match_keys").alias("key")).distinct()
    keys = keys.withColumn("prefix", _prefix(F.col("key"), F.lit(prefixes)))
    path = f"{root}/keys/{attempt}"
    keys.repartition("prefix").sortWithinPartitions("prefix", "key").write.partitionBy("prefix").parquet(path)
    written = spark.read.schema("key binary, prefix int").parquet(path)
    (written.groupBy("prefix", _bucket(F.col("key"), F.lit(buckets)).alias("bucket"))
     .agg(F.bitmap_construct_agg(_bit(F.col("key"))).alias("bits"))
     .select("prefix", "bucket", F.lit(prefixes).alias("prefixes"), F.lit(buckets).alias("buckets"),
             F.lit(attempt).alias("attempt"), "bits")
     .coalesce(1 + buckets // 64).write.parquet(f"{root}/filters/{attempt}"))
    return prefixes, buckets


def _key_paths(spark: SparkSession, root: str, asked: DataFrame) -> list[str]:
    """The key folders that may hold one of the asked keys: at most 256 for each live attempt."""
    attempts = _attempts(read_ledger(spark, root))
    if not attempts:
        return []
    filters = spark.read.schema(_FILTER).parquet(*(f"{root}/filters/{a['attempt']}" for a in attempts))
    key = F.col("key")
    sizes = F.array(*(  # powers of two, so that there are few pairs of them
        F.struct(F.lit(p).alias("prefixes"), F.lit(b).alias("buckets"))
        for p, b in sorted({(a["prefixes"], a["buckets"]) for a in attempts})))
    placed = asked.select("key", F.inline(sizes)).select(
        _prefix(key, F.col("prefixes")).alias("prefix"), _bucket(key, F.col("buckets")).alias("bucket"),
        "prefixes", "buckets", _bit(key).alias("bit")).distinct()
    byte = F.conv(F.hex(F.expr("substring(bits, int(bit DIV 8) + 1, 1)")), 16, 10).cast("int")
    hits = placed.join(filters, ["prefix", "bucket", "prefixes", "buckets"]).where(F.getbit(byte, F.col("bit") % 8) == 1)
    found = hits.select("attempt", "prefix").distinct().orderBy("attempt", "prefix").collect()
    return [f"{root}/keys/{r['attempt']}/prefix={r['prefix']}" for r in found]


def known_keys(spark: SparkSession, root: str, asked: DataFrame) -> DataFrame:
    """Those of the asked keys (``key``) that a stored article answers to."""
    paths = _key_paths(spark, root, asked)
    if not paths:
        return asked.limit(0)
    return asked.join(spark.read.schema("key binary").parquet(*paths), "key", "left_semi")


# --- batches ----------------------------------------------------------------------------------


def _record(
    spark: SparkSession, root: str, attempt: str, layout: tuple[int, int], source: str | None,
    batch: int | None, replaces: list[str],
) -> None:
    """Make an attempt visible. The files' ranges come from the one column they are about."""
    stored = spark.read.schema(STORED_ARTICLE).parquet(f"{root}/articles/{attempt}")
    files = stored.groupBy(F.col("_metadata.file_name").alias("name")).agg(
        F.max("_metadata.file_size").alias("bytes"), F.count("*").alias("rows"), F.min("category").alias("low"),
        F.max("category").alias("high"), F.bool_or(F.col("category").isNull()).alias("nulls"))
    about = spark.createDataFrame(
        [(attempt, source, batch, replaces, *layout)],
        "attempt string, source string, batch long, replaces array<string>, prefixes int, buckets int")
    named = files.select(F.lit(attempt).alias("attempt"), *files.columns)
    (about.unionByName(named, allowMissingColumns=True).select(*spark.createDataFrame([], LEDGER).columns)
     .coalesce(1).write.parquet(f"{root}/ledger/{attempt}"))


def commit_batch(messages: DataFrame, root: str, batch: int, source: str = "main") -> bool:
    """Store the unseen articles and the rejected messages of a batch, both or neither.

    A batch is known by its number in its ``source``; one that was committed before adds nothing and
    gives false. Articles are unseen as ``dedupe.append_unseen`` says, whatever batch they come in. A
    batch without articles or without messages is recorded too.
    """
    spark = messages.sparkSession
    ledger = read_ledger(spark, root)
    if not ledger.where((F.col("source") == source) & (F.col("batch") == batch)).isEmpty():
        return False
    attempt = uuid.uuid4().hex
    rows = with_match_keys(decode_messages(messages))
    # only keys are kept; the texts that will be written are read from the messages again
    asked = write_and_read(rows.select("asks", "match_keys").distinct(), "asked-keys")
    known = known_keys(spark, root, asked.select(F.col("asks").alias("key")))
    fresh = write_and_read(fresh_keys(asked, known.select(F.array("key").alias("match_keys"))), "fresh-keys")
    unseen(rows, fresh).sortWithinPartitions("category").write.parquet(f"{root}/articles/{attempt}")
    rejected_messages(messages).select("value", "reason").write.parquet(f"{root}/rejects/{attempt}")
    _record(spark, root, attempt, _write_keys(spark, root, attempt), source, batch, [])
    return True


def compact(spark: SparkSession, root: str, small_bytes: int = FILE_BYTES, file_bytes: int = FILE_BYTES) -> bool:
    """Rewrite attempts of less than ``small_bytes`` as one, in files of about ``file_bytes`` by category.

    False if fewer than two are small; then nothing is written.
    """
    small = [a for a in _attempts(read_ledger(spark, root)) if a["bytes"] < small_bytes]
    if len(small) < 2:
        return False
    names, attempt = [a["attempt"] for a in small], uuid.uuid4().hex
    files = max(1, round(sum(a["bytes"] for a in small) / file_bytes))
    articles = spark.read.schema(STORED_ARTICLE).parquet(*(f"{root}/articles/{n}" for n in names))
    # a category of any size is cut by the keys of its articles
    (articles.repartitionByRange(files, "category", "match_keys").sortWithinPartitions("category")
     .write.parquet(f"{root}/articles/{attempt}"))
    rejects = spark.read.schema(_REJECT).parquet(*(f"{root}/rejects/{n}" for n in names))
    rejects.coalesce(files).write.parquet(f"{root}/rejects/{attempt}")
    _record(spark, root, attempt, _write_keys(spark, root, attempt), None, None, names)
    return True


def vacuum(spark: SparkSession, root: str) -> int:
    """Delete the data of attempts that were replaced or never recorded; the number of them.

    Run it when no writer is at work, and no reader that began before the last compaction.
    """
    live = {a["attempt"] for a in _attempts(read_ledger(spark, root))}
    jvm, gone = spark._jvm.org.apache.hadoop.fs, set()
    for kind in ("articles", "rejects", "keys", "filters"):
        folder = jvm.Path(f"{root}/{kind}")
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        for entry in files.listStatus(folder) if files.exists(folder) else ():
            if entry.getPath().getName() not in live:
                gone.add(entry.getPath().getName())
                files.delete(entry.getPath(), True)
    return len(gone)


# --- reading ----------------------------------------------------------------------------------


def scan_articles(spark: SparkSession, root: str, equals: dict[str, object] | None = None) -> DataFrame:
    """Committed articles, filtered by equality; of a category only files that may hold it are opened."""
    files = _live(read_ledger(spark, root)).where("name IS NOT NULL")
    if equals and "category" in equals:
        value = equals["category"]
        files = files.where(F.col("nulls") if value is None else F.lit(value).between(F.col("low"), F.col("high")))
    paths = [f"{root}/articles/{r['attempt']}/{r['name']}"
             for r in files.select("attempt", "name").orderBy("attempt", "name").collect()]
    stored = spark.read.schema(STORED_ARTICLE).parquet(*paths) if paths else spark.createDataFrame([], STORED_ARTICLE)
    return matching(stored.select(*ARTICLE_FIELDS), equals or {})


def read_rejects(spark: SparkSession, root: str) -> DataFrame:
    """``value, reason`` of the committed batches' rejected messages."""
    paths = [f"{root}/rejects/{a['attempt']}" for a in _attempts(read_ledger(spark, root))]
    return spark.read.schema(_REJECT).parquet(*paths) if paths else spark.createDataFrame([], _REJECT)
