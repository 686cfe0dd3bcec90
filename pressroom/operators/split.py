"""Train/test splits and fixed-size batches."""

from __future__ import annotations

from fractions import Fraction
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressroom.session import write_and_read

# The weights and seeds of the main trainer, the tuned families and boosting.
MAIN_SPLIT = ([0.7, 0.3], 100)
TUNED_SPLIT = ([0.7, 0.2], 42)
BOOSTED_SPLIT = ([0.8, 0.2], 42)
# Fixed value: rows per training batch.
BATCH_ROWS = 10_000

_STEPS = 10_000


def random_split(df: DataFrame, weights: list[float], seed: int) -> list[DataFrame]:
    """Random parts of ``df``. Weights are normalized, so no row is left out.

    Which row goes where depends on the partitioning; ``hash_split`` does not.
    """
    return df.randomSplit(weights, seed)


def hash_part(key: Column, weights: list[float]) -> Column:
    """The part number of a key, from its MD5 alone: the same in any engine and partitioning."""
    total, edge = sum(weights), 0.0
    draw = F.conv(F.substring(F.md5(key.cast("string")), 1, 6), 16, 10).cast("long") % _STEPS
    part = F.lit(len(weights) - 1)
    edges = []
    for i, w in enumerate(weights[:-1]):
        edge += w
        edges.append((i, round(edge / total * _STEPS)))
    for i, upper in reversed(edges):
        part = F.when(draw < upper, F.lit(i)).otherwise(part)
    return part


def hash_fold(key: Column, folds: int) -> Column:
    """A fold number from other digits of the key's MD5 than ``hash_part`` reads."""
    return (F.conv(F.substring(F.md5(key.cast("string")), 7, 6), 16, 10).cast("long") % folds).cast("int")


def hash_split(df: DataFrame, key_col: str, weights: list[float]) -> list[DataFrame]:
    """Repeatable parts of ``df`` by a hash of a key column. No row is left out."""
    part = hash_part(F.col(key_col), weights)
    return [df.where(part == i) for i in range(len(weights))]


_BITS, _STEP_BITS = 60, 15
# Of monotonically_increasing_id: a row's place in its partition; the partition is in the bits above.
_PLACE_BITS = 33


def exact_split(df: DataFrame, key_col: str, share: float) -> tuple[DataFrame, DataFrame]:
    """``(rest, part)`` of ``df``, the part having exactly ``ceil(share * rows)`` rows.

    Those are the rows with the least hashes of their key, so the split is repeatable and no sort or
    task sees all rows: hashes are counted by their leading bits, and only the rows of the group that
    holds the cut are counted by further ones. Rows that tie at the cut, which share a key, are
    numbered in the order of the key and divided. Null is a key like others.
    """
    hash_ = F.conv(F.substring(F.md5(F.coalesce(F.col(key_col).cast("string"), F.lit(""))), 1, _BITS // 4), 16, 10)
    hashed = df.withColumn("_hash", hash_.cast("long"))
    wanted = ceil(Fraction(str(share)) * hashed.count())
    if not wanted:
        return df, df.limit(0)
    cut, left, group = 0, wanted, hashed.select("_hash")
    for done in range(_STEP_BITS, _BITS + 1, _STEP_BITS):
        prefix = F.shiftright("_hash", _BITS - done)
        counts = group.groupBy(prefix.alias("p")).agg(F.count(F.lit(1)).alias("n"))
        upto = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, 0)  # at most 2 ** 15 rows
        at = counts.withColumn("upto", F.sum("n").over(upto)).where(F.col("upto") >= left).orderBy("p").first()
        cut, left = at["p"], left - (at["upto"] - at["n"])
        if done < _BITS:
            group = write_and_read(group.where(prefix == cut), "split-group")
    whole = at["n"] == left
    below, tied = F.col("_hash") < cut, F.col("_hash") == cut
    if whole:
        return hashed.where(~(below | tied)).drop("_hash"), hashed.where(below | tied).drop("_hash")
    numbered = with_row_index(hashed.where(tied), key_col, "_tie")
    take = numbered.where(F.col("_tie") < left).drop("_tie")
    leave = numbered.where(F.col("_tie") >= left).drop("_tie")
    return (hashed.where(F.col("_hash") > cut).unionByName(leave).drop("_hash"),
            hashed.where(below).unionByName(take).drop("_hash"))


def with_row_index(df: DataFrame, order_col: str, output_col: str = "row_index") -> DataFrame:
    """Number the rows from 0 in the order of a column, nulls first, without one big sort.

    The rows are dealt to ranges of the order, whose bounds Spark takes from a sample, sorted there and
    written with their range and place, so that they are shuffled once; then the sizes of the ranges before
    are added. Equal values get successive numbers in no certain order. Any column
    that can be sorted will do; as the ranges are written, a recomputed task can't number otherwise.
    """
    order = F.col(order_col).asc_nulls_first()
    dealt = write_and_read(
        df.repartitionByRange(order).sortWithinPartitions(order)
        .withColumn("_place", F.monotonically_increasing_id()), "ranges")
    dealt = dealt.withColumn("_range", F.shiftright("_place", _PLACE_BITS))
    # One row per range from here on.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_size")).select(
        "_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    inside = F.col("_place").bitwiseAND((1 << _PLACE_BITS) - 1)
    return (
        dealt.join(F.broadcast(offsets), "_range")
        .withColumn(output_col, (F.col("_offset") + inside).cast("long"))
        .drop("_range", "_offset", "_place")
    )


def with_batches(df: DataFrame, order_col: str, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """Add ``batch``: contiguous slices of ``batch_rows`` rows in the order of a column."""
    indexed = with_row_index(df, order_col, "_row")
    return indexed.withColumn("batch", F.expr(f"_row div {int(batch_rows)}")).drop("_row")


def batch_bounds(df: DataFrame, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """``(batch, start_row, end_row)`` of the slices.

    There are ``rows div batch_rows + 1`` of them, so an exact multiple ends with an empty one.
    """
    rows = df.agg(F.count(F.lit(1)).alias("rows"))
    batches = F.expr(f"sequence(0L, rows div {int(batch_rows)})")
    slices = rows.select("rows", F.explode(batches).alias("batch"))
    start = F.col("batch") * batch_rows
    return slices.select(
        "batch", start.alias("start_row"),
        F.least(start + batch_rows, F.col("rows")).alias("end_row"),
    )
