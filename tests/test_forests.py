import json

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from pressroom.plans import forests
from pressroom.plans.train import Prepared
from pressroom.plans.tune import RF_RANGES, grid_point, grid_size

LIBRARY = {"numTrees": 5, "featureSubsetStrategy": "all", "seed": 3, "maxBins": 16}


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    out = []
    for i in range(400):
        at = sorted(rng.choice(9, int(rng.integers(0, 7)), replace=False).tolist())
        values = [float(rng.integers(1, 5)) for _ in at]
        dense = dict(zip(at, values))
        label = int(dense.get(0, 0) + dense.get(3, 0) > 4) + int(dense.get(5, 0) > 2)
        if rng.random() < 0.15:
            label = int(rng.integers(0, 3))
        v = Vectors.sparse(9, at, values) if i % 5 else Vectors.dense([dense.get(k, 0.0) for k in range(9)])
        out.append((i, float(label), v))
    return spark.createDataFrame(out, ["id", "label", "features"]).repartition(3).cache()


def confusion(scored):
    return {(r["label"], r["prediction"]): r["count"] for r in scored.groupBy("label", "prediction").count().collect()}


def nested(spark, rows, model, cuts, sizes):
    found = forests.nested_confusions(rows, forests.forest_of(spark, model), cuts, sizes).collect()
    out = {}
    for r in found:
        out.setdefault((r["cut"], r["size"]), {})[r["label"], r["prediction"]] = r["n"]
    return out


def test_cut_trees_equal_single_fits(spark, rows):
    deep = RandomForestClassifier(maxDepth=8, **LIBRARY).fit(rows)
    cuts = [(0, 0.0), (2, 0.0), (3, 0.05), (8, 0.0), (8, 0.02)]
    found = nested(spark, rows, deep, cuts, [5])
    for k, (depth, gain) in enumerate(cuts):
        single = RandomForestClassifier(maxDepth=depth, minInfoGain=gain, **LIBRARY).fit(rows)
        assert found[k, 5] == confusion(single.transform(rows)), (depth, gain)


def test_first_trees_vote_as_the_library_counts(spark, rows):
    model = RandomForestClassifier(maxDepth=4, numTrees=6, seed=1, featureSubsetStrategy="sqrt").fit(rows)
    found = nested(spark, rows, model, [(4, 0.0)], [1, 4, 6])
    assert found[0, 6] == confusion(model.transform(rows))
    for size in (1, 4):
        expected = {}
        for r in rows.collect():
            votes = np.zeros(3)
            for tree in model.trees[:size]:
                raw = tree.predictRaw(r["features"]).toArray()
                votes += raw / raw.sum()
            key = (int(r["label"]), int(votes.argmax()))
            expected[key] = expected.get(key, 0) + 1
        assert found[0, size] == expected


def test_blocks_of_rows_change_nothing(spark, rows, monkeypatch):
    model = RandomForestClassifier(maxDepth=5, **LIBRARY).fit(rows)
    whole = nested(spark, rows, model, [(2, 0.0), (5, 0.1)], [2, 5])
    monkeypatch.setattr(forests, "_CELLS", 1)
    assert nested(spark, rows, model, [(2, 0.0), (5, 0.1)], [2, 5]) == whole
    with pytest.raises(ValueError, match="ascend"):
        nested(spark, rows, model, [(2, 0.0)], [6])
    assert nested(spark, rows.limit(0), model, [(2, 0.0)], [5]) == {}


def test_a_search_fits_once_for_each_kind(spark, rows, monkeypatch):
    fits = []
    fit = forests.fit_classifier
    monkeypatch.setattr(forests, "fit_classifier", lambda *a: fits.append(a[2]) or fit(*a))
    train, test = rows.where("id < 300"), rows.where("id >= 300")
    prepared = Prepared(None, ["a", "b", "c"], rows, train.select("features", "label"), test.select("features", "label"))
    base = {"featureSubsetStrategy": "all", "maxBins": 16}
    points = [base | {"numTrees": 4, "maxDepth": d, "minInfoGain": g, "minInstancesPerNode": m, "checkpointInterval": c}
              for d in (2, 5) for g in (0.0, 0.1) for m in (1, 20) for c in (10, 50)]
    trials = forests.search_forests(prepared, enumerate(points), seed=3).collect()
    assert len(fits) == 2 and [r["trial"] for r in trials] == list(range(16))
    for r in trials:
        point = json.loads(r["params"])
        assert point == points[r["trial"]]
        if point["checkpointInterval"] == 50 or point["maxDepth"] == 5 and point["minInfoGain"]:
            continue
        single = RandomForestClassifier(seed=3, **point).fit(train).transform(test)
        right = single.where(F.col("label") == F.col("prediction")).count()
        assert r["accuracy"] == pytest.approx(right / 100), point


def test_the_whole_grid_needs_few_fits():
    kinds = forests.kinds_of((t, grid_point(RF_RANGES, t)) for t in range(grid_size(RF_RANGES)))
    assert grid_size(RF_RANGES) == 230_400 and len(kinds) == 480
    assert {len(k) for k in kinds.values()} == {480}
