import math
from collections import Counter

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from pressroom.operators import vectors
from pressroom.plans.boosted_text import load_boosted_text, train_boosted_text
from pressroom.plans.boosting import Settings
from pressroom.plans.features import term_table_pipeline, tfidf_pipeline

TEXTS = ["red fox jumps", "red red dog", "blue dog sleeps", "blue blue fox", None, "", "the and of"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, TEXTS[i % len(TEXTS)], "warm" if i % len(TEXTS) < 2 else "cold") for i in range(35)]
    return spark.createDataFrame(rows, "doc_id long, text string, category string").repartition(4).cache()


def test_same_numbers_as_the_stages_of_the_library(spark, docs, tmp_path):
    model = term_table_pipeline(path=f"{tmp_path}/terms").fit(docs)
    model.write().overwrite().save(f"{tmp_path}/model")
    model = PipelineModel.load(f"{tmp_path}/model")
    names = {r["index"]: r["term"] for r in model.stages[-1].terms(spark).collect()}
    assert sorted(names.values()) == [names[i] for i in range(len(names))]
    got = {r["doc_id"]: {names[i]: v for i, v in zip(r["features"]["indices"], r["features"]["values"])}
           for r in model.transform(docs).collect()}
    known = tfidf_pipeline().fit(docs)
    expected = {i: {} for i in range(35)}
    for r in vectors.vector_terms(known.transform(docs), "features", known.stages[3].vocabulary, "doc_id").collect():
        expected[r["doc_id"]][r["term"]] = pytest.approx(r["value"])
    assert got == expected


def test_unknown_terms_are_left_out(spark, docs):
    model = term_table_pipeline().fit(docs)
    names = {r["term"]: (r["index"], r["df"]) for r in model.stages[-1].terms(spark).collect()}
    new = spark.createDataFrame([(1, "red zebra fox fox")], "doc_id long, text string")
    features = model.transform(new).first()["features"]
    counts = Counter(["red", "fox", "fox"])
    weight = {names[t][0]: n * (math.log(36 / (1 + names[t][1])) + 1) for t, n in counts.items()}
    norm = math.sqrt(sum(w * w for w in weight.values()))
    assert dict(zip(features["indices"], features["values"])) == pytest.approx({i: w / norm for i, w in weight.items()})


def test_no_vocabulary_on_the_driver(spark, docs, monkeypatch):
    """Fitting brings no term to the driver, and the plan broadcasts hot terms and range sizes only."""
    from pyspark.sql import DataFrame

    def refuse(self, *_):
        raise AssertionError("collected")

    for name in ("collect", "toPandas", "toArrow", "toLocalIterator"):
        monkeypatch.setattr(type(docs), name, refuse)
        monkeypatch.setattr(DataFrame, name, refuse)
    term_table_pipeline().fit(docs)


def test_boosted_text_from_training_to_a_loaded_model(spark, docs, tmp_path):
    model, counts = train_boosted_text(
        docs, "doc_id", f"{tmp_path}/model", Settings(max_depth=2, min_child_weight=0.5), batch_rows=20)
    assert sum(r["n"] for r in counts.collect()) > 0 and len(model.booster.rounds) == 11
    model.save(f"{tmp_path}/saved", spark)
    again = load_boosted_text(spark, f"{tmp_path}/saved")
    scored = docs.withColumn("prediction", F.lit("x"))
    got = {r["doc_id"]: r for r in again.predict(scored).collect()}
    assert len(got) == 35 and again.booster == model.booster
    assert all(r["predicted"] == r["category"] for r in got.values() if r["text"] and "red" in r["text"] or "blue" in (r["text"] or ""))
    assert got[0].asDict().keys() == {"doc_id", "text", "category", "prediction", "predicted"}


def test_rows_of_the_fit_are_those_of_the_model(spark, docs):
    """One reading of the texts gives the model and its rows; ids that come again and null ids too."""
    *earlier, terms = term_table_pipeline().getStages()
    twice = docs.unionByName(docs.where("doc_id < 3")).unionByName(docs.where("doc_id < 2").withColumn("doc_id", F.lit(None).cast("long")))
    for df in (docs, twice):
        tokens = PipelineModel(earlier).transform(df)
        model, rows = terms.fit_rows(tokens, "category")
        known = terms.fit(tokens)
        assert sorted(model.terms(spark).collect()) == sorted(known.terms(spark).collect())
        expected = known.transform(tokens).select("doc_id", "category", "features.indices", "features.values")
        got, want = (sorted([*r[:3], [round(v, 9) for v in r[3]]] for r in x.na.fill(-1).collect()) for x in (rows, expected))
        assert got == want


def test_a_repeated_id_has_the_entries_of_all_its_rows(spark):
    rows = spark.createDataFrame([(1, ["a", "b"]), (1, ["a", "c"]), (2, ["a"]), (3, None), (4, [])], "id long, words array<string>")
    terms = spark.createDataFrame([("a", 3, 0), ("b", 1, 1), ("c", 1, 2)], "term string, df long, index long")
    got = vectors.tfidf_rows(rows, "id", "words", terms, 5).collect()
    a, b = math.log(6 / 4) + 1, math.log(6 / 2) + 1
    norm = math.sqrt(2 * a * a + 2 * b * b)
    twice = [r for r in got if r["id"] == 1]
    assert len(got) == 5 and len(twice) == 2
    assert all(r["indices"] == [0, 0, 1, 2] for r in twice)
    assert all(r["values"] == pytest.approx([a / norm, a / norm, b / norm, b / norm]) for r in twice)
    assert {r["id"]: r["indices"] for r in got if r["id"] > 1} == {2: [0], 3: [], 4: []}


def test_looking_up_shuffles_terms_of_blocks_and_no_postings(spark, docs):
    plan = term_table_pipeline().fit(docs).transform(docs).select("features")._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Window" not in plan
