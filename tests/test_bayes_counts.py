import numpy as np
import pytest
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.linalg import Vectors

from pressroom.plans import bayes_counts
from pressroom.plans.models import fit_classifier
from pressroom.plans.tune import NB_RANGES, grid_points


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    out = []
    for i in range(240):
        label = int(rng.integers(0, 3))
        at = sorted(rng.choice(10, int(rng.integers(0, 6)), replace=False).tolist())
        values = [float(rng.integers(1, 4) + (2 if t % 3 == label else 0)) for t in at]
        out.append((float(label), i % 4, Vectors.sparse(10, at, values)))
    return spark.createDataFrame(out, ["label", "fold", "features"]).repartition(3).cache()


def confusion(rows):
    return {(r["label"], r["prediction"]): r["n"] for r in rows}


@pytest.mark.parametrize("kind", ["multinomial", "bernoulli", "complement"])
def test_models_predict_as_the_library_does(rows, kind):
    points = [p for p in grid_points(NB_RANGES) if p["modelType"] == kind and p["smoothing"] > 0]
    train, test = rows.where("fold < 3"), rows.where("fold = 3")
    counts = bayes_counts.class_counts(train, 3, 10)
    got = bayes_counts._confusions(test, bayes_counts._models(counts, points, False), 1).collect()
    for i, point in enumerate(points):
        scored = fit_classifier(train, "nb", point).transform(test).groupBy("label", "prediction").count()
        assert confusion(r for r in got if r["trial"] == i) == {
            (r["label"], r["prediction"]): r["count"] for r in scored.collect()}


def test_a_fold_is_scored_without_itself(rows):
    points = [{"smoothing": 0.5}, {"smoothing": 2.0}]
    counts = bayes_counts.class_counts(rows, 3, 10, 4)
    assert counts.docs.sum() == 240
    got = bayes_counts._confusions(rows, bayes_counts._models(counts, points, True), 4).collect()
    for fold in range(4):
        model = NaiveBayes(smoothing=2.0).fit(rows.where(f"fold <> {fold}"))
        scored = model.transform(rows.where(f"fold = {fold}")).groupBy("label", "prediction").count().collect()
        assert confusion(r for r in got if (r["trial"], r["fold"]) == (1, fold)) == {
            (r["label"], r["prediction"]): r["count"] for r in scored}


def test_unknown_model_type(rows):
    with pytest.raises(ValueError, match="unknown model type"):
        bayes_counts.log_model(np.ones(2), np.ones((2, 3)), np.ones((2, 3)), 1.0, "gaussian")
