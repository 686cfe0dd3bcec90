"""Links between records: comparing within groups of any size, and connected components.

No step emits the pairs of a group. A group is cut into blocks, each two blocks meet in a task, and
what leaves the task is a row per record: how much it links to there, and one record it is connected
to. Blocks are bounded, so a group with a third of all rows becomes many tasks of one size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressroom.session import write_and_read

#: Records of a block.
BLOCK = 256


def roots(linked: np.ndarray) -> np.ndarray:
    """For each record of a symmetric boolean matrix the first record it is connected to."""
    n = len(linked)
    label = np.arange(n)
    while True:
        least = np.minimum(label, np.where(linked, label, n).min(axis=1))
        least = least[least]
        if (least == label).all():
            return label
        label = least


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of a sorted task, one table per (group, i, j); never more than two blocks are held."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        keys = np.column_stack([batch.column(c).to_numpy() for c in ("group", "i", "j")])
        cuts = (np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist()
        for a, b in zip([0, *cuts], [*cuts, len(keys)]):
            if held and (keys[a] != last).any():
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = keys[a]
    if held:
        yield pa.Table.from_batches(held)


def _runs(groups: Iterator[pa.Table], together: int) -> Iterator[list[pa.Table]]:
    """Groups of two records or more, in runs of up to so many records, or alone."""
    held: list[pa.Table] = []
    rows = 0
    for table in groups:
        if table.num_rows < 2:
            continue
        if held and rows + table.num_rows > together:
            yield held
            held, rows = [], 0
        held.append(table)
        rows += table.num_rows
    if held:
        yield held


def compare(
    records: DataFrame, similar: Callable[[list[bytes]], np.ndarray], block: int = BLOCK,
    together: int = 0,
) -> DataFrame:
    """``node, links, root`` for records ``group, node, weight, payload``.

    ``similar`` gives the symmetric boolean matrix of some payloads. Within its group every record
    meets every other one once; ``links`` sums the weights of those it is similar to, over the tasks
    it is in (sum them by node), and ``root`` is a node it is connected to by similar pairs there, or
    itself. Groups of one record, and null groups, give no row. A node must be in a group only once.
    Small groups are handed to ``similar`` several at once, up to ``together`` records.
    """
    sizes = records.groupBy("group").agg(F.count("*").alias("size")).where("size > 1")
    blocks = F.ceil(F.col("size") / block).cast("int")
    dealt = (
        records.join(sizes, "group")
        .select("group", "node", "weight", "payload", blocks.alias("blocks"),
                F.pmod(F.xxhash64("node"), blocks).cast("int").alias("own"))
        .select("group", "node", "weight", "payload", "own",
                F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        .select("group", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                "own", "node", "weight", "payload")
        .repartition("group", "i", "j").sortWithinPartitions("group", "i", "j", "node"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tables in _runs(_groups(batches), together):
            part = np.repeat(np.arange(len(tables)), [t.num_rows for t in tables])
            table = pa.concat_tables(tables)
            nodes = table["node"].to_numpy()
            linked = similar(table["payload"].to_pylist())
            np.fill_diagonal(linked, False)
            own = table["own"].to_numpy()
            two = (table["i"].to_numpy() != table["j"].to_numpy())  # of two blocks, only pairs across
            linked &= (part[:, None] == part) & ~(two[:, None] & (own[:, None] == own))
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes), pa.array((linked @ table["weight"].to_numpy()).astype(np.int64)),
                 pa.array(nodes[roots(linked)])], names=["node", "links", "root"])

    return dealt.mapInArrow(run, "node long, links long, root long")


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node of the edges ``a, b``: equal roots where they are connected.

    Each round sends every node to its neighbour of least random rank and contracts the graph, which
    shrinks it by a constant share whatever its shape; a round ends in a written table. Nothing but
    the number of edges left reaches the driver.
    """
    spark = edges.sparkSession
    current = write_and_read(
        edges.select(F.col("a").cast("long"), F.col("b").cast("long"))
        .where("a <> b").distinct(), "edges")
    moves: DataFrame | None = None
    number = 0
    while not current.isEmpty():
        number += 1

        def rank(c):
            return F.struct(F.xxhash64(c, F.lit(number)).alias("r"), F.col(c).alias("n"))

        both = current.union(current.select("b", "a"))
        best = both.groupBy("a").agg(F.min(rank("b")).alias("best"))
        step = write_and_read(
            best.select("a", F.least(rank("a"), "best")["n"].alias("to")), "step")
        left = step.select(F.col("a"), F.col("to").alias("x"))
        right = step.select(F.col("a").alias("b"), F.col("to").alias("y"))
        current = write_and_read(
            current.join(left, "a").join(right, "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
            .where("a <> b").distinct(), "edges")
        if moves is None:
            moves = step.select(F.col("a").alias("node"), F.col("to").alias("root"))
        else:
            later = step.select(F.col("a").alias("root"), F.col("to").alias("later"))
            moves = write_and_read(moves.join(later, "root", "left").select(
                "node", F.coalesce("later", "root").alias("root")), "roots")
    return moves if moves is not None else spark.createDataFrame([], "node long, root long")
