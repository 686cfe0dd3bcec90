import random

import numpy as np
import pytest
from llm_helpers import union_find
from pyspark.sql import functions as F

from pressroom.llm.links import compare, components, roots


def same_partition(got, expected):
    pairs = {(got[n], expected[n]) for n in expected}
    return len({a for a, _ in pairs}) == len({b for _, b in pairs}) == len(pairs)


@pytest.mark.parametrize("shape", ["path", "star", "random", "none"])
def test_components(spark, shape):
    rng = random.Random(4)
    edges = {
        "path": [(i, i + 1) for i in range(60)],
        "star": [(0, i) for i in range(1, 60)] + [(100, 101)],
        "random": [(rng.randrange(80), rng.randrange(80)) for _ in range(60)],
        "none": [(5, 5)],
    }[shape]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {n for a, b in edges if a != b for n in (a, b)}
    assert got.keys() == nodes
    assert same_partition(got, union_find(nodes, [e for e in edges if e[0] != e[1]]))


def test_roots():
    linked = np.zeros((6, 6), bool)
    for a, b in [(0, 3), (3, 5), (1, 2)]:
        linked[a, b] = linked[b, a] = True
    assert roots(linked).tolist() == [0, 1, 1, 0, 4, 0]


@pytest.mark.parametrize("together", [0, 50])
def test_every_pair_of_a_group_meets_once_in_blocks(spark, together):
    def near(payloads):
        values = np.array([int(p) for p in payloads])
        return np.abs(values[:, None] - values[None, :]) <= 3

    rng = random.Random(7)
    rows = [(g, g * 1000 + i, 1 + i % 3, str(rng.randrange(200)).encode())
            for g, size in ((1, 90), (2, 2), (3, 1), (4, 17)) for i in range(size)]
    df = spark.createDataFrame(rows + [(None, 9, 1, b"1")], "group long, node long, weight long, payload binary")
    out = compare(df, near, block=8, together=together)
    links = {r["node"]: r["links"] for r in out.groupBy("node").agg(F.sum("links").alias("links")).collect()}
    expected, edges = {}, []
    for g, node, _, value in rows:
        others = [(n, w) for h, n, w, v in rows if h == g and n != node and abs(int(v) - int(value)) <= 3]
        if g != 3:
            expected[node] = sum(w for _, w in others)
        edges += [(node, n) for n, _ in others]
    assert links == expected
    found = components(out.select(F.col("node").alias("a"), F.col("root").alias("b")))
    got = {r["node"]: r["root"] for r in found.collect()}
    assert same_partition(got, {n: r for n, r in union_find(expected, edges).items() if n in got})
    assert got.keys() == {n for e in edges for n in e}
