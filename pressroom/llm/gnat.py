"""Hard negatives of integer vectors, by a multiway hyperplane tree in the manner of GNAT.

A node's rows go each to the nearest of some split points, so hyperplanes part them. For every child the
node stores the least and largest distance of its rows from every split point, its own and its siblings'.
A window on inner products with a query is a window on distances (an annulus): vectors get one more
coordinate that makes them equally long, which leaves products with a query, whose own is 0, as they are.
By the triangle inequality a child can be left out if for any split point its range of distances misses
what the annulus allows. What remains are leaves, where products are exact integers.

Tree, queries and leaves are tables. Rows of a node and those that visit it meet in a task, a bounded
part of either at a time; nothing of the tree passes through the driver but its number of levels.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressroom.session import write_and_read

#: Split points of a node; rows of a leaf at most.
FANOUT, LEAF = 32, 4096
#: Visitors of a node that one task takes.
VISITORS = 1 << 16
#: Queries whose products with a leaf are in memory at once.
BLOCK = 256
#: Quantised components are limited to this, so that products of up to 8192 of them fit a long.
LARGEST = 1 << 25
#: Distances are compared with this part of the longest vector to spare, far above their rounding.
SPARE = 1e-6
_LOWEST, _HIGHEST = -(1 << 62), 1 << 62


# --- vectors ----------------------------------------------------------------------------------


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column of equally long lists as rows."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), len(flat) // max(len(column), 1))


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows, as doubles where those hold them, else as longs."""
    x, y = a.astype(np.float64), b.astype(np.float64)
    longest = [(v * v).sum(axis=1).max(initial=0.0) for v in (x, y)]
    if longest[0] * longest[1] < 2.0 ** 104:  # by Cauchy and Schwarz no partial sum reaches 2 ** 52
        return x @ y.T
    return a.astype(np.int64) @ b.astype(np.int64).T


def _squares(a: np.ndarray) -> np.ndarray:
    x = a.astype(np.float64)
    return (x * x).sum(axis=1)


def _rest(a: np.ndarray, longest: float) -> np.ndarray:
    """The coordinate that makes every row as long as the longest one, given squared."""
    return np.sqrt(np.maximum(longest - _squares(a), 0.0))


def _apart(square: np.ndarray | float, products: np.ndarray) -> np.ndarray:
    """Distances from sums of squared lengths and products."""
    return np.sqrt(np.maximum(square - 2 * products, 0.0))


# --- meeting ----------------------------------------------------------------------------------


def _meet(
    holders: DataFrame, visitors: DataFrame, visits: DataFrame,
    prepare: Callable[[pa.Table], object],
    each: Callable[[object, pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str,
) -> DataFrame:
    """``each`` of what ``prepare`` makes of a node's holders, and each lot of the node's visitors.

    ``visits`` has ``node, parts``: a node's visitors are dealt over so many tasks, each of which gets
    all its holders (bounded in number by the caller). Nodes without visitors are left out.
    """
    held = holders.join(visits, "node").withColumn(
        "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).drop("parts")
    several = visits.where("parts > 1")
    coming = visitors.join(several, "node", "left").withColumn(
        "part", F.pmod(F.xxhash64("key"), F.coalesce("parts", F.lit(1).cast("long")))).drop("parts")
    both = held.withColumn("visits", F.lit(False)).unionByName(
        coming.withColumn("visits", F.lit(True)), allowMissingColumns=True)
    order = ["node", "part", "visits"]
    both = both.select(*order, *(c for c in both.columns if c not in order))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, ready = None, [], None
        for batch in batches:
            node, part = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            coming = batch.column(2).to_numpy(zero_copy_only=False)
            change = (np.diff(node) != 0) | (np.diff(part) != 0) | (coming[1:] != coming[:-1])
            bounds = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
            for a, b in zip(bounds, bounds[1:]):
                if a == b:
                    continue
                some = batch.slice(a, b - a)
                if (node[a], part[a]) != at:
                    at, held, ready = (node[a], part[a]), [], None
                if not coming[a]:
                    held.append(some)
                elif held:
                    if ready is None:
                        ready = prepare(pa.Table.from_batches(held))
                    for k in range(0, some.num_rows, BLOCK):
                        yield from each(ready, some.slice(k, BLOCK))

    return both.repartition("node", "part").sortWithinPartitions(*order).mapInArrow(run, schema)


def _visits(visitors: DataFrame) -> DataFrame:
    """``node, parts``, written, so that its size is known where it is joined."""
    return write_and_read(visitors.groupBy("node").agg(
        F.ceil(F.count("*") / VISITORS).alias("parts")), "visits")


# --- tree -------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Tree:
    """``splits``: level, node, i, q (the split point), child, least and most (distances of the child's
    rows from every point of the node), inner (whether the child is split too). ``leaves``: rows with
    their leaf as ``node``. ``longest``: the largest squared length."""

    splits: DataFrame
    leaves: DataFrame
    levels: int
    longest: float


def build(items: DataFrame, root: Column, longest: float, leaf: int = LEAF, fanout: int = FANOUT) -> Tree:
    """A tree for each value of ``root`` over ``items`` (``key, q`` and more; all ``q`` of a root equally long).

    Nodes of more than ``leaf`` rows are split, level by level, by ``fanout`` of their rows, those with
    the least hashes. Every row is indexed and every node above that size split; only equal vectors
    could not be told apart, so items must be distinct.
    """
    rows = write_and_read(items.withColumn("node", root.cast("long")), "tree-rows")
    columns = rows.columns
    row_schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    splits, leaves, level = [], [], 0
    while True:
        sizes = write_and_read(rows.groupBy("node").agg(F.count("*").alias("n")).where(F.col("n") > leaf), "tree-sizes")
        if sizes.isEmpty():
            leaves.append(rows)
            break
        marked = rows.join(sizes, "node", "left")
        leaves.append(marked.where("n IS NULL").select(*columns))
        large = marked.where("n IS NOT NULL")
        draw = Window.partitionBy("node").orderBy(F.xxhash64("key", F.lit(level)), "key")
        points = write_and_read(
            large.withColumn("i", F.row_number().over(draw) - 1).where(F.col("i") < fanout)
            .select("node", "i", "q", F.xxhash64("node", "i").alias("child")), "tree-points")

        def prepare(held: pa.Table) -> tuple:
            held = held.sort_by("i")
            q = _matrix(held.column("q"))
            return q, _rest(q, longest), held.column("child").to_numpy()

        def assign(points: tuple, some: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            q, rest, child = points
            x = _matrix(some.column("q"))
            near = _products(x, q) + _rest(x, longest)[:, None] * rest
            to = near.argmax(axis=1)
            distance = _apart(2 * longest, near)
            found = np.unique(to)
            least = np.stack([distance[to == c].min(axis=0) for c in found])
            most = np.stack([distance[to == c].max(axis=0) for c in found])
            moved = {name: some.column(name) for name in columns} | {"node": pa.array(child[to])}
            n, m, k = some.num_rows, len(found), len(child)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(n, np.int32)), *(moved[c] for c in columns),
                 *(pa.nulls(n, t) for t in (pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64())))],
                names=["kind", *columns, "child", "least", "most"])
            each = np.arange(0, m * k + 1, k, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ones(m, np.int32)), *(pa.nulls(m, moved[c].type) for c in columns),
                 pa.array(child[found]), *(pa.ListArray.from_arrays(each, x.reshape(-1)) for x in (least, most))],
                names=["kind", *columns, "child", "least", "most"])

        visits = sizes.select("node", F.ceil(F.col("n") / VISITORS).alias("parts"))
        dealt = write_and_read(_meet(
            points, large.drop("n"), visits, prepare, assign,
            f"kind int, {row_schema}, child long, least array<double>, most array<double>"), "tree-level")
        rows = dealt.where("kind = 0").select(*columns)
        ranges = dealt.where("kind = 1").select("child", F.posexplode(F.arrays_zip("least", "most")).alias("j", "d"))
        ranges = ranges.groupBy("child", "j").agg(F.min("d.least").alias("least"), F.max("d.most").alias("most"))
        by_point = F.sort_array(F.collect_list(F.struct("j", "least", "most")))
        ranges = ranges.groupBy("child").agg(by_point.alias("d")).select(
            "child", F.col("d.least").alias("least"), F.col("d.most").alias("most"))
        splits.append(points.join(ranges, "child").withColumn("level", F.lit(level)))
        level += 1
    every = leaves[0]
    for some in leaves[1:]:
        every = every.unionByName(some)
    if not splits:
        empty = rows.select(
            "node", F.lit(0).alias("i"), "q", F.col("node").alias("child"), F.array(F.lit(0.0)).alias("least"),
            F.array(F.lit(0.0)).alias("most"), F.lit(0).alias("level"), F.lit(False).alias("inner")).limit(0)
        return Tree(empty, every, 0, longest)
    whole = splits[0]
    for some in splits[1:]:
        whole = whole.unionByName(some)
    nodes = whole.select(F.col("node").alias("child")).distinct().withColumn("inner", F.lit(True))
    whole = whole.join(nodes, "child", "left").withColumn("inner", F.coalesce("inner", F.lit(False)))
    return Tree(write_and_read(whole, "tree-splits"), every, level, longest)


# --- search -----------------------------------------------------------------------------------

_QUERY = "key long, lab long, q array<int>, low array<long>, high array<long>, node long"


def _surviving(q: np.ndarray, low: list, high: list, points: np.ndarray, least: np.ndarray,
               most: np.ndarray, longest: float) -> np.ndarray:
    """For each query and child, whether the ranges meet an annulus of one of the query's windows."""
    square = _squares(q) + longest
    far = _apart(square[:, None], _products(q, points))
    spare = SPARE * np.sqrt(longest) + 1e-9
    out = np.zeros((len(q), len(points)), bool)
    for w in range(max(map(len, low), default=0)):
        has = np.array([len(x) > w and x[w] <= y[w] for x, y in zip(low, high)])
        bounds = np.array([(x[w], y[w]) if h else (0, 0) for x, y, h in zip(low, high, has)], np.float64)
        outer, inner = _apart(square, bounds[:, 0]), _apart(square, bounds[:, 1])
        at_least = np.maximum(far - outer[:, None], inner[:, None] - far) - spare
        at_most = far + outer[:, None] + spare
        meets = ((most[None] >= at_least[:, None, :]) & (least[None] <= at_most[:, None, :])).all(axis=2)
        out |= meets & has[:, None]
    return out


def candidates(tree: Tree, queries: DataFrame) -> DataFrame:
    """``queries`` (``key, lab, q, low, high, node``, the node being a root) with every leaf they must see."""
    inner_roots = tree.splits.where("level = 0").select("node").distinct().withColumn("inner", F.lit(True))
    frontier = write_and_read(
        queries.join(inner_roots, "node", "left").withColumn("inner", F.coalesce("inner", F.lit(False))), "frontier")
    names = [name.split()[0] for name in _QUERY.split(", ")]
    arrived = frontier.where("NOT inner").select(*names)
    longest = tree.longest

    def prepare(held: pa.Table) -> tuple:
        held = held.sort_by("i")
        return (_matrix(held.column("p")), _matrix(held.column("least")), _matrix(held.column("most")),
                held.column("child").to_numpy(), held.column("inner").to_numpy())

    def each(ready: tuple, some: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        points, least, most, child, inner = ready
        keep = _surviving(_matrix(some.column("q")), some.column("low").to_pylist(),
                          some.column("high").to_pylist(), points, least, most, longest)
        row, to = np.nonzero(keep)
        kept = some.select(names[:-1]).take(pa.array(row))
        yield pa.RecordBatch.from_arrays(
            [*kept.columns, pa.array(child[to]), pa.array(inner[to])], names=[*names, "inner"])

    for level in range(tree.levels):
        visitors = frontier.where("inner").select(*names)
        holders = tree.splits.where(F.col("level") == level).select(
            "node", "i", F.col("q").alias("p"), "child", "least", "most", "inner")
        frontier = write_and_read(
            _meet(holders, visitors, _visits(visitors), prepare, each, f"{_QUERY}, inner boolean"), "frontier")
        arrived = arrived.unionByName(frontier.where("NOT inner").select(*names))
    return arrived


def scan(tree: Tree, visiting: DataFrame, best: int, same: bool) -> DataFrame:
    """``key, w, score, id``: of each leaf visited, the ``best`` rows in each window of a query.

    Rows of the query's label with ``same``, else of others; higher scores first, then smaller ids. A
    row of a leaf stands for all its ``ids`` (ascending).
    """

    def prepare(held: pa.Table) -> tuple:
        held = held.combine_chunks()
        ids = held.column("ids").combine_chunks()
        return (_matrix(held.column("x")), held.column("own").to_numpy(),
                ids.flatten().to_numpy(), np.append(0, np.cumsum(ids.value_lengths().to_numpy())))

    def each(ready: tuple, some: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        x, own, ids, bounds = ready
        keys, labs = some.column("key").to_numpy(), some.column("lab").to_numpy()
        low, high = some.column("low").to_pylist(), some.column("high").to_pylist()
        products = _products(_matrix(some.column("q")), x)
        out: list[list] = [[], [], [], []]
        for r in range(len(keys)):
            right = np.flatnonzero((own == labs[r]) == same)
            scores = products[r, right]
            for w, (a, b) in enumerate(zip(low[r], high[r])):
                at = np.flatnonzero((scores >= a) & (scores <= b))
                if len(at) > best:  # ties of the last one stay, ids decide
                    at = at[scores[at] >= np.partition(scores[at], -best)[-best]]
                found = sorted((-int(scores[i]), int(n)) for i in at.tolist()
                               for n in ids[bounds[right[i]]:bounds[right[i] + 1]])[:best]
                out[0] += [int(keys[r])] * len(found)
                out[1] += [w] * len(found)
                out[2] += [-s for s, _ in found]
                out[3] += [n for _, n in found]
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, t) for v, t in zip(out, kinds)], names=["key", "w", "score", "id"])

    holders = tree.leaves.select("node", F.col("q").alias("x"), F.col("lab").alias("own"), "ids")
    return _meet(holders, visiting, _visits(visiting), prepare, each, "key long, w int, score long, id long")


def _best(found: DataFrame, best: int) -> DataFrame:
    """The ``best`` rows of each query and window, numbered from 1 as ``rank``."""
    order = Window.partitionBy("key", "w").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)


def nearest_in_windows(tree: Tree, queries: DataFrame, best: int, same: bool) -> DataFrame:
    """``key, w, score, id, rank`` of the ``best`` rows in each window, exactly.

    ``queries`` has ``key, lab, q, low, high, root, leaf``. The query's own leaf is looked at first: with
    ``best`` rows found there, only higher or equal scores count, which narrows the window.
    """
    queries = write_and_read(queries, "queries")
    names = [name.split()[0] for name in _QUERY.split(", ")]
    first = scan(tree, queries.withColumn("node", F.col("leaf")).select(*names), best, same)
    least = first.groupBy("key", "w").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(
        F.col("n") >= best)
    least = least.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("w", "least"))).alias("least"))
    narrowed = queries.join(least, "key", "left").withColumn("low", F.transform("low", lambda x, w: F.greatest(
        x, F.coalesce(F.try_element_at("least", w), x))))
    arrived = candidates(tree, narrowed.withColumn("node", F.col("root")).select(*names))
    return _best(scan(tree, write_and_read(arrived, "arrived"), best, same), best)


# --- mining -----------------------------------------------------------------------------------


def mine(
    vectors: DataFrame, is_anchor: Column, id_column: str = "vec_id", vector_column: str = "vector",
    label_column: str = "label", positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
    leaf: int = LEAF, fanout: int = FANOUT,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``vectors`` holds integer vectors; a score is the inner product of two. For each anchor and each of
    its ``positives`` best other rows of its label, the best ``negatives`` rows of other labels whose
    score is from ``low`` to ``high`` percent of the positive's. Higher scores come first, then smaller
    ids. All results are exact.

    Rows with a null id, label, vector or component take no part; vectors of different lengths don't
    compare. Repeated rows count as often as they occur, and an anchor's other copies are other rows.
    Equal vectors of a label are searched for once and stand in the tree once, with as many of their
    least ids as results can use. No row, or no negative in any window, no result. Other columns are
    left out, whatever their names.
    """
    best = max(positives + 1, negatives)
    source = vectors.select(
        F.col(id_column).cast("long").alias("id"), F.xxhash64(label_column).alias("lab"),
        F.col(vector_column).cast("array<int>").alias("q"), is_anchor.alias("anchor"),
        F.col(label_column).alias("label")).where(
        "id IS NOT NULL AND label IS NOT NULL AND q IS NOT NULL AND NOT exists(q, x -> x IS NULL)").drop("label")
    order = Window.partitionBy("lab", "q").orderBy("id")
    least = source.withColumn("n", F.row_number().over(order)).where(F.col("n") <= best)
    items = write_and_read(least.groupBy("lab", "q").agg(F.sort_array(F.collect_list("id")).alias("ids")).select(
        F.monotonically_increasing_id().alias("key"), "lab", "q", "ids"), "items")
    longest = items.agg(F.max(F.aggregate(
        "q", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))).alias("m")).first()["m"] or 0.0
    by_label, by_length = F.xxhash64("lab", F.size("q")), F.xxhash64(F.size("q"))
    own = build(items, by_label, longest, leaf, fanout)
    all_ = build(items, by_length, longest, leaf, fanout)

    anchors = write_and_read(source.where("anchor").select("id", "lab", "q").join(
        items.select("key", "lab", "q"), ["lab", "q"]).select("id", "key"), "anchors")
    asked = write_and_read(anchors.groupBy("key").agg(F.ceil(F.count("*") / VISITORS).alias("parts")), "asked")
    percent = lambda s, p: s.cast("decimal(19,0)") * p / F.lit(100).cast("decimal(3,0)")
    queries = items.join(asked.select("key"), "key", "left_semi").select("key", "lab", "q")
    leaf_of = own.leaves.select("key", F.col("node").alias("leaf"))
    first = nearest_in_windows(own, queries.join(leaf_of, "key").select(
        "key", "lab", "q", F.array(F.lit(_LOWEST)).alias("low"), F.array(F.lit(_HIGHEST)).alias("high"),
        by_label.alias("root"), "leaf"), positives + 1, same=True)
    positive = write_and_read(first.groupBy("key").agg(F.sort_array(F.collect_list(
        F.struct("rank", "score", "id"))).alias("positive")), "positives")

    scores = F.array_sort(F.array_distinct(F.col("positive.score")))
    windows = queries.join(positive, "key").withColumn("scores", scores)
    leaf_of = all_.leaves.select("key", F.col("node").alias("leaf"))
    found = nearest_in_windows(all_, windows.join(leaf_of, "key").select(
        "key", "lab", "q", F.transform("scores", lambda s: F.ceil(percent(s, low)).cast("long")).alias("low"),
        F.transform("scores", lambda s: F.floor(percent(s, high)).cast("long")).alias("high"),
        by_length.alias("root"), "leaf"), negatives, same=False)
    negative = found.groupBy("key", "w").agg(F.sort_array(F.collect_list(F.struct("rank", "score", "id"))).alias("found"))
    negative = negative.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("w", "found"))).alias("negative"))

    # a vector's results go to each of its anchors; those of very many are dealt over several tasks
    results = positive.join(negative, "key").join(asked, "key").withColumn(
        "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    several = asked.where("parts > 1")
    dealt = anchors.join(several, "key", "left").withColumn(
        "part", F.pmod(F.xxhash64("id"), F.coalesce("parts", F.lit(1).cast("long")))).drop("parts")
    joined = dealt.join(results.drop("parts"), ["key", "part"])
    itself = F.array_position(F.col("positive.id"), F.col("id")) - 1
    others = F.slice(F.filter("positive", lambda p, i: i != itself), 1, positives)
    distinct = F.array_sort(F.array_distinct(F.col("positive.score")))
    pairs = joined.select(
        F.col("id").alias("anchor_id"), "negative", distinct.alias("scores"), F.explode(others).alias("p"))
    of_score = F.try_element_at("negative", (F.array_position("scores", F.col("p.score")) - 1).cast("int"))
    return pairs.select(
        "anchor_id", F.col("p.id").alias("positive_id"), F.col("p.score").alias("positive_score"),
        F.explode(of_score).alias("n")).select(
        "anchor_id", "positive_id", F.col("n.rank").cast("int").alias("rank"), F.col("n.id").alias("negative_id"),
        "positive_score", F.col("n.score").alias("negative_score"))


def hard_negatives_query(embeddings: DataFrame) -> DataFrame:
    """Components become floor(256 x), limited to 2 ** 25 either way; a seventh of the labels move on by one."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    component = lambda x: F.greatest(F.least(
        F.floor(x.cast("double") * 256.0), F.lit(LARGEST)), F.lit(-LARGEST)).cast("int")
    rows = embeddings.select("vec_id", label.alias("label"), F.when(
        finite, F.transform("embedding", component)).alias("vector"))
    return mine(rows, F.col("vec_id") % 100 == 0)


HARD_NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
    list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT anchor_id, id, score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, p.id AS positive_id,
  (row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id))::INT AS rank,
  s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
  AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) <= 10
"""
