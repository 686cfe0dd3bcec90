"""Helpers that ask the caller's session about the cluster. No session is created here."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="pressroom-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder named by ``spark.checkpoint.dir``.

    A local session without that setting gets a temporary folder; a cluster session without it is
    refused, since executors would not see one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = _local_root()
    return f"{root.rstrip('/')}/pressroom/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> bool:
    """Delete everything written through ``scratch_path``, when no result that reads it is needed."""
    folder = scratch_path(spark, "").rsplit("/", 1)[0]
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give RDD checkpoints (forests with cached node ids) the shared folder, if none is set."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_path(spark, "rdd"))


def write_and_read(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back.

    Cuts the lineage at a place that outlives executors, and gives the optimizer real file sizes.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(spark: SparkSession, values: list[str], index: str, value: str) -> DataFrame:
    """``(index, value)`` of a driver-side list, as a local relation.

    Its size is known to the optimizer, which broadcasts it below its threshold and else shuffles.
    """
    ids = pa.array(range(len(values)), pa.int32())
    return spark.createDataFrame(pa.table({index: ids, value: pa.array(values, pa.string())}))
