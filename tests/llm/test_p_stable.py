import math

import numpy as np
import pytest
from llm_helpers import union_find

from pressroom.llm.p_stable import buckets, digits_for, embedding_query, tables_for


def brute(rows):
    units = []
    for _, v, _ in rows:
        ok = v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
        units.append(np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64)) if ok else None)
    links, edges = [0] * len(rows), []
    for i in range(len(rows)):
        for j in range(i):
            if units[i] is None or units[j] is None or rows[i][2] is None or rows[i][2] != rows[j][2]:
                continue
            if len(units[i]) == len(units[j]) and units[i] @ units[j] >= 0.93:
                links[i] += 1
                links[j] += 1
                edges.append((i, j))
    return links, union_find(range(len(rows)), edges)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_links_are_those_of_brute_force(spark, kind):
    rng = np.random.default_rng(3)
    rows = []
    for c in range(12):
        centre = rng.standard_normal(32)
        for _ in range(25):
            noise = rng.standard_normal(32) * rng.choice([0.05, 0.2, 0.27, 0.3])
            rows.append(((centre + noise).astype(np.float32).astype(float).tolist(), c % 3))
    rows += [([1.0] * 32, 1)] * 300 + [([2.0] * 32, 1)] * 5
    rows += [(None, 1), ([], 1), ([0.0] * 32, 1), ([None] + [1.0] * 31, 1), ([float("nan")] + [1.0] * 31, 1),
             ([float("inf")] * 32, 1), ([1.0] * 32, None), ([1.0] * 32, None), ([1.0] * 31, 1), ([1e38] * 32, 1)]
    rows = [(5 + 3 * i, v, label) for i, (v, label) in enumerate(rows)]
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int").repartition(5)
    links, root = brute(rows)
    got = {r["vec_id"]: r for r in embedding_query(df).collect()}
    assert len(got) == len(rows)
    missing = sum(got[key]["n_links"] != links[i] for i, (key, _, _) in enumerate(rows))
    assert missing == 0
    first = {}
    for i, (key, _, _) in enumerate(rows):
        first.setdefault(root[i], key)
    for i, (key, _, _) in enumerate(rows):
        assert got[key]["component_id"] == first[root[i]] and got[key]["kept"] == (first[root[i]] == key)


def test_close_vectors_share_a_bucket():
    rng = np.random.default_rng(1)
    a = rng.standard_normal((2000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    noise = rng.standard_normal(a.shape)
    noise -= (noise * a).sum(axis=1, keepdims=True) * a
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    b = 0.93 * a + math.sqrt(1 - 0.93 ** 2) * noise
    digits = digits_for(10_000)
    tables = tables_for(digits)
    found = (buckets(a, digits, tables) == buckets(b, digits, tables)).any(axis=1)
    assert found.mean() > 0.99


def test_no_rows(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_query(df).count() == 0
