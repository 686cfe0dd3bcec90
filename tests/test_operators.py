import math
from collections import Counter

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from pressroom.operators import evaluate, labels, profile, split, vectors

WORDS = [
    "the cat sat on the mat".split(),
    "the dog sat".split(),
    [],
    "a cat and a dog and a cow".split(),
]


def documents(spark):
    return spark.createDataFrame(list(enumerate(WORDS)), "id long, words array<string>")


def test_vocabulary_breaks_ties_by_term(spark):
    got = [r["term"] for r in vectors.vocabulary(documents(spark), "words", 5).collect()]
    counts = Counter(w for ws in WORDS for w in ws)
    assert got == sorted(counts, key=lambda w: (-counts[w], w))[:5]


def test_count_vectors(spark):
    df = documents(spark)
    model = vectors.VocabularyVectorizer(inputCol="words", outputCol="features", vocabSize=0).fit(df)
    got = {
        (r["id"], r["term"]): r["value"]
        for r in vectors.vector_terms(model.transform(df), "features", model.vocabulary, "id").collect()
    }
    assert got == {(i, w): float(n) for i, ws in enumerate(WORDS) for w, n in Counter(ws).items()}
    binary = vectors.VocabularyVectorizer(
        inputCol="words", outputCol="features", vocabSize=3, binary=True
    ).fit(df)
    values = vectors.vector_entries(binary.transform(df), "features", "id").select("value").distinct()
    assert [r["value"] for r in values.collect()] == [1.0]


@pytest.mark.parametrize("size", [1, 2, 3, 4, 100])
def test_vocabulary_cut(spark, size):
    counts = Counter(w for ws in WORDS for w in ws)
    expected = sorted(counts, key=lambda w: (-counts[w], w))[:size]
    got = vectors.vocabulary(documents(spark), "words", size)
    assert [r["term"] for r in got.collect()] == expected


def test_batches_of_null_and_text_keys(spark):
    df = spark.createDataFrame([(1,), (None,), (3,), (None,)], "id int")
    got = split.with_batches(df, "id", 2).collect()
    assert sorted((r["batch"], r["id"] or 0) for r in got) == [(0, 0), (0, 0), (1, 1), (1, 3)]
    text = spark.createDataFrame([("b",), ("a",), ("c",)], "id string")
    got = {r["id"]: r["row_index"] for r in split.with_row_index(text, "id").collect()}
    assert got == {"a": 0, "b": 1, "c": 2}


def test_predictions_outside_the_labels_stay(spark):
    table = spark.createDataFrame([(0, "a"), (1, "b")], "label int, category string")
    df = spark.createDataFrame([(0.0,), (None,), (5.0,)], "prediction double")
    got = labels.lookup_category(df, table).collect()
    assert sorted((str(r["prediction"]), r["category"]) for r in got) == [
        ("0.0", "a"), ("5.0", None), ("None", None)]


def expected_tfidf():
    df = Counter(w for ws in WORDS for w in set(ws))
    out = {}
    for i, ws in enumerate(WORDS):
        weights = {
            w: n * (math.log((1 + len(WORDS)) / (1 + df[w])) + 1) for w, n in Counter(ws).items()
        }
        norm = math.sqrt(sum(v * v for v in weights.values()))
        out.update({(i, w): v / norm for w, v in weights.items()})
    return out


@pytest.mark.parametrize("hot_terms", [10_000, 10, 1])
def test_tfidf_table_with_any_share_of_hot_terms(spark, monkeypatch, hot_terms):
    monkeypatch.setattr(vectors, "HOT_TERMS", hot_terms)
    got = {
        (r["id"], r["term"]): r["value"]
        for r in vectors.tfidf_table(documents(spark), "id", "words").collect()
    }
    assert got == pytest.approx(expected_tfidf())


def test_tfidf_stages_agree(spark):
    df = documents(spark)
    counts = vectors.VocabularyVectorizer(inputCol="words", outputCol="counts", vocabSize=0).fit(df)
    counted = counts.transform(df)
    scaled = vectors.SmoothIdfScaler(inputCol="counts", outputCol="weights").fit(counted).transform(counted)
    from pyspark.ml.feature import Normalizer

    unit = Normalizer(inputCol="weights", outputCol="features").transform(scaled)
    got = {
        (r["id"], r["term"]): r["value"]
        for r in vectors.vector_terms(unit, "features", counts.vocabulary, "id").collect()
    }
    assert got == pytest.approx(expected_tfidf())


def categories(spark):
    return spark.createDataFrame(
        [(0, "z"), (1, "a"), (2, "a"), (3, "m"), (4, "m"), (5, "b")], "id long, category string"
    )


def test_label_orders(spark):
    df = categories(spark)
    assert labels.frequency_indexer().fit(df).labels == ["a", "m", "b", "z"]
    assert labels.alphabetical_indexer().fit(df).labels == ["a", "b", "m", "z"]
    ids = {r["category"]: (r["categoryId"], r["count"]) for r in labels.first_seen_ids(df, "id").collect()}
    assert ids == {"z": (0, 1), "a": (1, 2), "m": (2, 2), "b": (3, 1)}
    assert [r["category"] for r in profile.category_ids(df, "id").collect()] == ["z", "a", "m", "b"]


def test_label_map_and_lookup(spark):
    df = categories(spark)
    model = labels.frequency_indexer().fit(df)
    indexed = model.transform(df)
    expected = {(0, "a"), (1, "m"), (2, "b"), (3, "z")}
    assert {tuple(r) for r in labels.label_map(indexed).collect()} == expected
    table = labels.indexer_label_map(spark, model)
    assert {tuple(r) for r in table.collect()} == expected
    back = labels.lookup_category(indexed.drop("category"), table, "label")
    assert {(r["id"], r["category"]) for r in back.collect()} == {tuple(r) for r in df.collect()}


def test_random_split_loses_nothing(spark):
    df = spark.range(9000)
    a, b = split.random_split(df, *split.TUNED_SPLIT)
    assert a.count() + b.count() == 9000
    assert abs(a.count() / 9000 - 7 / 9) < 0.02


def test_hash_split_is_repeatable(spark):
    df = spark.range(5000)
    first = split.hash_split(df, "id", [0.7, 0.2])
    second = split.hash_split(df.repartition(7), "id", [0.7, 0.2])
    assert [p.count() for p in first] == [p.count() for p in second]
    assert sum(p.count() for p in first) == 5000
    assert first[0].exceptAll(second[0]).count() == 0
    assert abs(first[0].count() / 5000 - 7 / 9) < 0.03


def test_row_index_with_gaps_and_clumps(spark):
    ids = [i * i for i in range(500)] + list(range(10**9, 10**9 + 700)) + [-5]
    df = spark.createDataFrame([(i,) for i in ids], "id long").repartition(5)
    got = {r["id"]: r["row_index"] for r in split.with_row_index(df, "id").collect()}
    assert got == {v: i for i, v in enumerate(sorted(ids))}


def test_batches(spark):
    df = spark.range(25).repartition(4)
    got = {r["id"]: r["batch"] for r in split.with_batches(df, "id", 10).collect()}
    assert got == {i: i // 10 for i in range(25)}
    bounds = [tuple(r) for r in split.batch_bounds(spark.range(20), 10).collect()]
    assert bounds == [(0, 0, 10), (1, 10, 20), (2, 20, 20)]
    assert [tuple(r) for r in split.batch_bounds(spark.range(5), 10).collect()] == [(0, 0, 5)]


PAIRS = [(0.0, 0.0)] * 5 + [(0.0, 1.0)] * 2 + [(1.0, 1.0)] * 3 + [(1.0, 2.0)] + [(3.0, 0.0)] * 2


def test_weighted_metrics_agree_with_the_library(spark):
    df = spark.createDataFrame(PAIRS, "label double, prediction double")
    row = evaluate.weighted_metrics(evaluate.confusion(df)).first()
    for ours, theirs in [
        ("accuracy", "accuracy"), ("precision", "weightedPrecision"),
        ("recall", "weightedRecall"), ("f1", "f1"),
    ]:
        assert row[ours] == pytest.approx(MulticlassClassificationEvaluator(metricName=theirs).evaluate(df))
    assert evaluate.accuracy(df).first()[0] == pytest.approx(row["accuracy"])


def test_report(spark):
    df = spark.createDataFrame(PAIRS, "label double, prediction double")
    got = {r["class"]: r for r in evaluate.classification_report(evaluate.confusion(df)).collect()}
    assert set(got) == {"0.0", "1.0", "2.0", "3.0", "accuracy", "macro avg", "weighted avg"}
    assert got["0.0"]["precision"] == pytest.approx(5 / 7)
    assert got["2.0"]["precision"] == got["2.0"]["recall"] == got["3.0"]["precision"] == 0.0
    assert got["accuracy"]["f1"] == pytest.approx(8 / 13)
    assert got["macro avg"]["recall"] == pytest.approx((5 / 7 + 3 / 4 + 0 + 0) / 4)
    assert got["weighted avg"]["support"] == 13


def test_leaderboard_and_metric_rows(spark):
    low = spark.createDataFrame([(0.1, 0.2)], "accuracy double, f1 double")
    high = spark.createDataFrame([(0.9, 0.1)], "accuracy double, f1 double")
    assert [r["model"] for r in evaluate.leaderboard({"low": low, "high": high}).collect()] == ["high", "low"]
    rows = {tuple(r) for r in evaluate.metric_rows("m", low).collect()}
    assert rows == {("m", "accuracy", 0.1), ("m", "f1", 0.2)}


@pytest.mark.parametrize("ids", [[], [7], [3, 9]])
def test_row_index_of_very_few_rows(spark, ids):
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    got = {r["id"]: r["row_index"] for r in split.with_row_index(df, "id").collect()}
    assert got == {v: i for i, v in enumerate(sorted(ids))}


def test_tfidf_table_without_broadcasts_by_size(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table = vectors.tfidf_table(documents(spark), "id", "words")
        assert "SortMergeJoin" in table._jdf.queryExecution().sparkPlan().toString()
        got = {(r["id"], r["term"]): r["value"] for r in table.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == pytest.approx(expected_tfidf())


def test_tfidf_of_nothing(spark):
    empty = documents(spark).limit(0)
    assert vectors.tfidf_table(empty, "id", "words").count() == 0


def test_metrics_of_nothing(spark):
    df = spark.createDataFrame([], "label double, prediction double")
    assert tuple(evaluate.weighted_metrics(evaluate.confusion(df)).first()) == (0.0, 0.0, 0.0, 0.0)


def test_vocabulary_tokenizes_once(spark):
    from pressroom.functions.tokens import gap_tokenizer

    texts = spark.createDataFrame([("a b",)], "text string")
    plan = vectors.vocabulary(gap_tokenizer().transform(texts), "words", 5)
    shown = plan._jdf.queryExecution().optimizedPlan().toString()
    # the counts are written once; what is left reads them
    assert "UDF(" not in shown, shown


def test_exact_split_has_its_size(spark):
    rows = spark.range(0, 1003, 1, 4).select("id", (F.col("id") % 7).alias("other"))
    rest, part = split.exact_split(rows, "id", 0.2)
    taken = {r["id"] for r in part.collect()}
    assert len(taken) == 201 and rest.count() == 802
    assert taken.isdisjoint(r["id"] for r in rest.collect())
    again = split.exact_split(rows.repartition(3), "id", 0.2)[1]
    assert {r["id"] for r in again.collect()} == taken


def test_exact_split_divides_ties(spark):
    rows = spark.createDataFrame([(5,)] * 90 + [(None,)] * 10, "key long")
    for share, size in ((0.0, 0), (0.25, 25), (0.95, 95), (1.0, 100)):
        rest, part = split.exact_split(rows, "key", share)
        assert (part.count(), rest.count()) == (size, 100 - size)
    rest, part = split.exact_split(rows.limit(0), "key", 0.2)
    assert part.count() == rest.count() == 0
