"""Articles to topic messages and back. A message is a JSON array of articles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pressroom.schemas import ARTICLE_FIELDS, MESSAGE

# Fixed value: the topic both article shapes share.
TOPIC = "newsarticles"
# Bytes of a message; a broker refuses over 1 MiB unless told otherwise.
MESSAGE_BYTES = 1_000_000
# Bytes of messages that a worker joins at once, about.
JOINED_BYTES = 1 << 22


def _articles_json(df: DataFrame, keep_nulls: bool) -> DataFrame:
    fields = [f for f in df.columns if f in ARTICLE_FIELDS]
    options = {"ignoreNullFields": str(not keep_nulls).lower()}
    return df.select(F.to_json(F.struct(*fields), options).alias("json"))


def cut_messages(batches: Iterator[pa.RecordBatch], batch_size: int, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Messages of the rows of one partition, joined ``JOINED_BYTES`` or so at a time."""
    for batch in batches:
        # bytes up to each row, with its comma; a message has one more for its brackets
        lengths = pc.binary_length(batch.column(0)).to_numpy().astype(np.int64)
        before = np.append(0, np.cumsum(lengths + 1))
        starts = [0]
        while starts[-1] < batch.num_rows:
            at = starts[-1]
            fits = int(np.searchsorted(before, before[at] + max_bytes - 1, "right")) - 1
            starts.append(max(at + 1, min(at + batch_size, fits)))
        if not batch.num_rows:
            starts.append(0)
        lots = np.flatnonzero(np.diff(before[starts] // JOINED_BYTES)) + 1
        bounds = [0, *(k for k in lots.tolist() if k < len(starts) - 1), len(starts) - 1]
        for a, b in zip(bounds, bounds[1:]):
            # not a slice of a list array, which a join would take whole
            rows = batch.column(0).slice(starts[a], starts[b] - starts[a])
            chunks = pa.ListArray.from_arrays(pa.array(np.array(starts[a:b + 1]) - starts[a], pa.int32()), rows)
            joined = pc.binary_join_element_wise("[", pc.binary_join(chunks, ","), "]", "")
            yield pa.RecordBatch.from_arrays([joined], ["value"])


def encode_messages(
    df: DataFrame, batch_size: int = 100, keep_nulls: bool = False, max_bytes: int = MESSAGE_BYTES
) -> DataFrame:
    """``(value)`` messages of at most ``batch_size`` articles and ``max_bytes`` bytes each.

    An article that is larger than that makes a message of its own; ``oversize`` tells those apart.

    Messages are cut from the rows of one partition, in their order: nothing is shuffled, no
    message grows with the data however the rows are distributed, and a rerun task makes whole
    messages of the same rows. Articles become JSON in the JVM; Arrow only joins the strings.
    """

    return _articles_json(df, keep_nulls).mapInArrow(
        lambda batches: cut_messages(batches, batch_size, max_bytes), "value string")


def oversize(messages: DataFrame, max_bytes: int = MESSAGE_BYTES) -> DataFrame:
    """Messages that a topic would refuse: to count, and to land as files instead."""
    return messages.where(F.octet_length("value") > max_bytes)


def encode_groups(groups: DataFrame, keep_nulls: bool = True) -> DataFrame:
    """``(value)`` messages of ``search_groups`` rows: one per search that found anything."""
    options = {"ignoreNullFields": str(not keep_nulls).lower()}
    return groups.select(F.to_json("articles", options).alias("value"))


def decode_messages(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Articles of all messages in the wide shape; works on batch and streaming frames.

    A message that is not JSON, or not a list, yields nothing.
    """
    value = F.col(value_col).cast("string")
    return (
        df.where(F.ltrim(value).startswith("["))
        .select(F.inline(F.from_json(value, MESSAGE)))
    )


def rejected_messages(df: DataFrame, value_col: str = "value") -> DataFrame:
    """``df`` with ``reason`` for the messages that ``decode_messages`` takes nothing from."""
    value = F.col(value_col).cast("string")
    reason = (
        F.when(value.isNull(), "null")
        .when(~F.ltrim(value).startswith("["), "not a list")
        .when(F.from_json(value, MESSAGE, {"mode": "PERMISSIVE"}).isNull(), "not JSON"))
    return df.withColumn("reason", reason).where("reason IS NOT NULL")


def write_message_files(messages: DataFrame, path: str, mode: str = "append") -> None:
    """One message per line. JSON escapes line breaks, so a message never spans lines."""
    messages.select("value").write.mode(mode).text(path)


def read_message_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def write_topic(messages: DataFrame, servers: str, topic: str = TOPIC) -> None:
    """Send messages to a Kafka topic. Needs the Kafka connector on the classpath."""
    (
        messages.select("value").write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def start_publishing(
    messages: DataFrame, servers: str, checkpoint: str, topic: str = TOPIC, period: str | None = None
) -> StreamingQuery:
    """Send the messages of a stream to a Kafka topic, every ``period`` or what is there once.

    ``encode_messages`` works on streams too, so landed files can be published as they come.
    """
    trigger = {"processingTime": period} if period else {"availableNow": True}
    return (
        messages.select("value").writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def stream_topic(
    spark: SparkSession, servers: str, topic: str = TOPIC, max_offsets: int = 10_000
) -> DataFrame:
    """Messages of a Kafka topic from its beginning. Needs the Kafka connector on the classpath.

    A batch takes at most ``max_offsets`` messages, so the first one is not the whole topic.
    Offsets live in the query's checkpoint, in place of a consumer group.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", max_offsets)
        .load()
        .select(F.col("value").cast("string").alias("value"))
    )


def stream_message_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Messages of a folder that files land in."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)
