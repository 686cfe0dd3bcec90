import random

import numpy as np
from pyspark.sql import functions as F

from pressroom.llm import gnat

SCHEMA = "vec_id long, label int, vector array<int>, node string, part long"


def by_hand(rows, is_anchor, positives=5, negatives=10, low=30, high=90):
    ok = [(i, n, tuple(q)) for i, n, q, *_ in rows
          if i is not None and n is not None and q is not None and None not in q]
    out = []
    for at, (i, n, q) in enumerate(ok):
        if not is_anchor(i):
            continue
        score = lambda x: sum(a * b for a, b in zip(q, x))  # noqa: B023, E731
        alike = [(score(x), j, m) for k, (j, m, x) in enumerate(ok) if k != at and len(x) == len(q)]
        own = sorted((-s, j) for s, j, m in alike if m == n)[:positives]
        for p, j in own:
            p = -p
            found = sorted((-s, k) for s, k, m in alike if m != n and low * p <= 100 * s <= high * p)[:negatives]
            out += [(i, j, rank, k, p, -s) for rank, (s, k) in enumerate(found, 1)]
    return sorted(out, key=repr)


def mined(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, gnat.mine(df, F.col("vec_id") % 10 == 0, **options).collect()), key=repr)


def clustered(seed, n, dims, centres):
    rng = np.random.default_rng(seed)
    middle = rng.normal(0, 100, (centres, dims))
    at = middle[rng.integers(0, centres, n)]
    return np.floor(at + rng.normal(0, 4, (n, dims))).astype(int).tolist()


def test_as_by_hand_over_several_levels(spark):
    rng = random.Random(3)
    vectors = clustered(1, 600, 4, 30) + np.random.default_rng(2).integers(-9, 9, (300, 4)).tolist()
    rows = [(i, rng.randrange(3), q) for i, q in enumerate(vectors)]
    assert mined(spark, rows, leaf=40, fanout=5) == by_hand(rows, lambda i: i % 10 == 0)


def test_odd_rows(spark):
    rng = random.Random(4)
    rows = [(i, rng.randrange(2), [rng.randrange(-5, 5) for _ in range(3)]) for i in range(200)]
    rows += [(1000 + i, 1, [3, 1, 2]) for i in range(120)]  # many copies, anchors among them
    rows += [(None, 1, [3, 1, 2]), (2000, None, [3, 1, 2]), (2010, 1, None), (2020, 1, [1, None, 2])]
    rows += [(2030, 1, [0, 0, 0]), (2040, 0, []), (2050, 1, []), (2060, 0, [4, 4]), (2061, 1, [4, 3]), (2062, 0, [1, 1])]
    rows += [(2070, 0, [-4, -4, -4]), (2080, 0, [1 << 25] * 3), (2081, 1, [1 << 24] * 3), (2082, 0, [1 << 25] * 3)]
    rows += [(40, 1, [2, 2, 2]), (40, 1, [2, 2, 2]), (30, 0, [1, 2, 2])]  # ids that repeat
    assert mined(spark, rows, leaf=20, fanout=3) == by_hand(rows, lambda i: i % 10 == 0)
    assert mined(spark, rows[150:], positives=2, negatives=3, low=50, high=100) == by_hand(
        rows, lambda i: i % 10 == 0, 2, 3, 50, 100)


def test_no_rows(spark):
    assert mined(spark, []) == [] and mined(spark, [(10, 1, [1, 2]), (20, 1, [2, 2])]) == []


def test_every_row_is_in_one_leaf_of_bounded_size(spark):
    rows = [(i, [0], q) for i, q in enumerate(clustered(5, 1200, 5, 10))]
    items = spark.createDataFrame(rows, "key long, ids array<long>, q array<int>").withColumn("lab", F.lit(1))
    tree = gnat.build(items, F.lit(7), float(max(sum(x * x for x in q) for _, _, q in rows)), leaf=50, fanout=4)
    assert sorted(r.key for r in tree.leaves.collect()) == list(range(1200))
    assert max(r["count"] for r in tree.leaves.groupBy("node").count().collect()) <= 50
    assert tree.levels > 1


def test_ranges_leave_out_far_leaves(spark):
    """On clusters a narrow window of near vectors needs few leaves; no result is lost."""
    vectors = clustered(6, 1500, 8, 40)
    items = spark.createDataFrame(
        [(i, [i], q) for i, q in enumerate(vectors)], "key long, ids array<long>, q array<int>"
    ).withColumn("lab", F.col("key") % 5)
    x = np.array(vectors, float)
    longest = float((x * x).sum(axis=1).max())
    tree = gnat.build(items, F.lit(7), longest, leaf=60, fanout=8)
    own = (x * x).sum(axis=1).astype(int)
    asked = list(range(0, 1500, 50))
    queries = spark.createDataFrame(
        [(i, 9, vectors[i], [int(own[i] - 0.03 * own[i])], [int(own[i] + 0.03 * own[i])], 7) for i in asked], gnat._QUERY)
    visits = gnat.candidates(tree, queries).count()
    assert visits < 0.6 * len(asked) * tree.leaves.select("node").distinct().count()
    got = gnat._best(gnat.scan(tree, gnat.candidates(tree, queries), 1500, False), 1500)
    products = x @ x.T
    expected = sum((np.abs(products[i] - own[i]) <= int(0.03 * own[i])).sum() for i in asked)
    assert abs(got.count() - expected) <= len(asked)  # the windows' ends are cut to integers


def test_query_leaves_out_broken_components(spark):
    good = [(i, i % 3, [random.Random(i).uniform(-1, 1) for _ in range(4)]) for i in range(300)]
    bad = [(300, 1, [float("nan"), 0.0, 0.0, 0.0]), (400, 1, [float("inf"), 0.0, 0.0, 0.0]), (500, 1, None), (600, None, good[0][2])]
    df = spark.createDataFrame(good + bad, "vec_id long, label int, embedding array<float>")
    rows = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, [int(np.floor(256 * float(x))) for x in r.embedding])
            for r in df.collect()[:300]]
    assert sorted(map(tuple, gnat.hard_negatives_query(df).collect()), key=repr) == by_hand(rows, lambda i: i % 100 == 0)
