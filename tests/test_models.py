import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from pressroom.functions.tokens import FULL_STOP_WORDS
from pressroom.plans import models, tune
from pressroom.plans import train as training
from pressroom.plans.features import count_pipeline, tfidf_pipeline
from pressroom.plans.predict import predict, predict_text
from pressroom.plans.tune import (
    RANGES, best_trial, cross_validate, grid_points, grid_size, search, with_grid,
)
from pressroom.streaming.score import start_scoring

TOPICS = {
    "sports": "match goal team coach score league player win".split(),
    "tech": "chip software phone data code cloud robot network".split(),
    "health": "doctor virus vaccine hospital diet heart sleep clinic".split(),
}


@pytest.fixture(scope="module")
def articles(spark):
    rng = random.Random(3)
    rows = []
    for i in range(240):
        category = rng.choice([*TOPICS, "sports"])
        own = rng.choices(TOPICS[category], k=6)
        noise = rng.choices([w for ws in TOPICS.values() for w in ws], k=3)
        rows.append((i, " ".join(own + noise + ["the", "said"]), category))
    return spark.createDataFrame(rows, "id long, text string, category string").cache()


SMALL = {
    "lr": {"maxIter": 5},
    "nb": {},
    "rf": {"numTrees": 5, "maxDepth": 4, "seed": 1},
    "boosted": {"rounds": 2, "max_depth": 3},
}


@pytest.fixture(scope="module")
def prepared(articles):
    made = training.prepare(articles, count_pipeline(vocab_size=100), key="id")
    yield made
    training.release(made)


@pytest.mark.parametrize("family", list(SMALL))
def test_train_save_load_predict_and_stream(spark, articles, tmp_path, family):
    features = tfidf_pipeline() if family == "boosted" else count_pipeline(FULL_STOP_WORDS)
    trained = training.train(articles, family, SMALL[family], features=features, key="id")
    majority = 0.55
    assert trained.metrics.first()["accuracy"] > majority
    training.save(trained, str(tmp_path / "m"))
    model, labels = training.load(spark, str(tmp_path / "m"))
    assert [r["category"] for r in labels.orderBy("label").collect()] == trained.labels

    texts = articles.select("id", "text").unionByName(
        spark.createDataFrame([(-1, None), (-2, "unknown words")], "id long, text string")
    )
    batch = {r["id"]: r["predicted"] for r in predict(model, texts).collect()}
    assert len(batch) == 242 and set(batch.values()) <= set(TOPICS)

    texts.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(texts.schema).parquet(str(tmp_path / "in"))
    start_scoring(model, stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert {r["id"]: r["predicted"] for r in out.collect()} == batch


def test_predict_text(spark, articles):
    trained = training.train(articles, "nb", {}, key="id")
    assert predict_text(spark, trained.model, "goal team league") == "sports"


def test_default_family_and_random_split(articles):
    trained = training.train(articles)
    assert trained.model.stages[-2].getOrDefault("maxIter") == 15
    held_out = trained.counts.agg(F.sum("n")).first()[0]
    assert 40 < held_out < 105


def test_naive_bayes_by_hand(articles):
    trained = training.train(articles, "nb", {}, key="id")
    rows = articles.collect()
    from pressroom.operators.split import hash_split

    train_ids = {r["id"] for r in hash_split(articles, "id", [0.7, 0.3])[0].collect()}
    def tokens(text):
        return [w for w in text.split() if w != "the"]
    vocabulary = {w for r in rows for w in tokens(r["text"])}
    docs, words = Counter(), defaultdict(Counter)
    for r in rows:
        if r["id"] in train_ids:
            docs[r["category"]] += 1
            words[r["category"]].update(tokens(r["text"]))

    def score(c, text):
        prior = math.log(docs[c] + 1) - math.log(sum(docs.values()) + len(docs))
        total = sum(words[c].values()) + len(vocabulary)
        return prior + sum(math.log((words[c][w] + 1) / total) for w in tokens(text))

    got = {r["id"]: r["predicted"] for r in predict(trained.model, articles).collect()}
    assert got == {r["id"]: max(docs, key=lambda c: score(c, r["text"])) for r in rows}


def test_fit_on_train_leaves_test_words_out(articles):
    only_test = "zebra"
    from pressroom.operators.split import hash_part

    marked = articles.withColumn(
        "text",
        F.when(hash_part(F.col("id"), [0.7, 0.3]) == 1, F.concat("text", F.lit(f" {only_test}")))
        .otherwise(F.col("text")),
    )
    for fit_on, known in [("all", True), ("train", False)]:
        prepared = training.prepare(marked, key="id", fit_on=fit_on)
        assert (only_test in prepared.text_model.stages[-1].vocabulary) is known
        training.release(prepared)


def test_grids(spark):
    assert {f: grid_size(r) for f, r in RANGES.items()} == {
        "lr": 5184, "nb": 12, "rf": 230_400, "boosted": 120,
    }
    points = list(grid_points(RANGES["nb"]))
    assert points[1] == {"smoothing": 0.0, "modelType": "bernoulli"}
    frame = with_grid(spark.range(1), RANGES["nb"]).orderBy("trial").collect()
    assert [{k: r[k] for k in RANGES["nb"]} for r in frame] == points
    assert [r["trial"] for r in frame] == list(range(12))


def test_names_of_working_columns_are_free_for_callers(articles):
    trained = training.train(articles, "nb")
    busy = articles.select(
        "text", *(F.lit(1).alias(c) for c in ("words", "filtered", "features", "filled_text", "label",
                                              "probability", "prediction")))
    got = predict(trained.model, busy)
    assert got.columns == ["text", "words", "filtered", "features", "filled_text", "label", "probability",
                           "prediction", "predicted"]
    assert got.count() == articles.count()


def test_a_failing_job_is_not_a_trial(articles, monkeypatch):
    prepared = training.prepare(articles)

    def lost(*_):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(tune, "fit_classifier", lost)
    with pytest.raises(RuntimeError, match="executor lost"):
        tune.search(prepared, "nb", max_trials=1)


def test_search_records_failures_and_keeps_the_earliest_best(prepared):
    points = [
        {"smoothing": -1.0},                                # rejected by the library
        {"smoothing": 1.0},
        {"smoothing": 1.0, "modelType": "multinomial"},      # the same model, so a tie
        {"smoothing": 1.0, "modelType": "bernoulli"},
    ]
    for parallelism in (1, 3):
        found = search(prepared, "nb", points, stop_above=1.0, parallelism=parallelism)
        trials = {r["trial"]: r for r in found.trials.collect()}
        assert len(trials) == 4
        assert trials[0]["error"] and trials[0]["f1"] is None
        assert trials[1]["f1"] == trials[2]["f1"]
        assert all(trials[i]["error"] is None for i in (1, 2, 3))
        best = best_trial(found.trials).first()
        assert best["best"] and best["trial"] != 2


def test_search_stops_and_bounds(prepared):
    points = [{"smoothing": s} for s in (1.0, 2.0, 3.0)]
    assert search(prepared, "nb", points, stop_above=0.1, parallelism=2).trials.count() == 1
    assert search(prepared, "nb", points, stop_above=1.0, max_trials=2).trials.count() == 2
    binomial = [{"family": "binomial", "maxIter": 1}, {"family": "multinomial", "maxIter": 1}]
    assert [r["trial"] for r in search(prepared, "lr", binomial).trials.collect()] == [1]
    assert search(prepared, "nb", [{"smoothing": -1.0}]).model is None


def test_cross_validate(prepared):
    got = cross_validate(prepared, {"regParam": [0.1, 10.0]}, folds=2, maxIter=3)
    assert got.folds.count() == 2
    assert 0 <= got.test_score <= 1


@pytest.mark.parametrize("family, params", [
    ("rf", {"numTrees": 1, "bootstrap": False, "maxDepth": 2, "featureSubsetStrategy": "all", "seed": 1}),
    ("boosted", {"rounds": 1, "max_depth": 1})])
def test_no_task_reads_many_dense_rows(spark, monkeypatch, family, params):
    """One part of wide rows is dealt out before trees make it dense, and the trees are the same."""
    rows = spark.createDataFrame([
        (float(i % 2), Vectors.sparse(1000, [i % 2, 2 + i % 997], [1.0, 1.0])) for i in range(400)],
        StructType([StructField("label", DoubleType()), StructField("features", VectorUDT())])).coalesce(1)
    plain = [r["prediction"] for r in models.fit_classifier(rows, family, params, 2).transform(rows).collect()]
    monkeypatch.setattr(models, "DENSE_BYTES", 4 * 1000 * 10)
    with models.dense_parts(rows) as dealt:
        sizes = dealt.groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in sizes) <= 20 and sum(r["count"] for r in sizes) == 400
    assert [r["prediction"] for r in models.fit_classifier(rows, family, params, 2).transform(rows).collect()] == plain
