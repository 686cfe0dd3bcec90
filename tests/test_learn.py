import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pressroom.streaming.learn import classify, compact, counts_so_far, learn_batch, start_learning, start_scoring_latest

SCHEMA = "doc_id long, text string, category string"
ROWS = [
    (1, "goal match goal", "sport"), (2, "match team", "sport"), (3, "vote party", "news"), (4, "party vote law", "news"),
    (5, "law match", "news"), (6, None, "sport"), (7, "", "sport"), (8, "goal", None), (9, "unknown words", "news"),
]


def by_hand(train, texts, smoothing=1.0):
    docs = Counter(c for _, _, c in train if c)
    terms = {c: Counter() for c in docs}
    for _, text, c in train:
        if c:
            terms[c].update((text or "").split())
    vocabulary = set().union(*terms.values())
    out = {}
    for i, text, *_ in texts:
        words = [w for w in (text or "").split() if w in vocabulary]
        score = {c: math.log(docs[c] + smoothing) + sum(
            math.log((terms[c][w] + smoothing) / (sum(terms[c].values()) + smoothing * len(vocabulary))) for w in words)
            for c in docs}
        out[i] = max(sorted(score, key=lambda c: (-docs[c], c)), key=score.get)
    return out


def predicted(df):
    return {r["doc_id"]: r["predicted"] for r in df.collect()}


def test_batches_add_up_and_replays_change_nothing(spark, tmp_path):
    rows = spark.createDataFrame(ROWS, SCHEMA)
    path = f"{tmp_path}/model"
    for batch in (0, 1, 2, 1):
        learn_batch(rows.where(F.col("doc_id") % 3 == batch), path, batch)
    learn_batch(rows.limit(0), path, 3)
    learn_batch(rows.where("doc_id = 1"), path, 0, source="other")
    train = [*ROWS, ROWS[0]]
    got = predicted(classify(rows, "doc_id", counts_so_far(spark, path)))
    assert got == by_hand(train, ROWS)
    compact(spark, path, f"{tmp_path}/compacted")
    again = counts_so_far(spark, f"{tmp_path}/compacted")
    assert sorted(map(repr, again.collect())) == sorted(map(repr, counts_so_far(spark, path).collect()))


def test_stream_learns_and_the_scorer_takes_the_latest(spark, tmp_path):
    landed, model, out = (f"{tmp_path}/{x}" for x in ("landed", "model", "out"))

    def stream():
        return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(landed)

    def learn():
        start_learning(stream(), model, f"{tmp_path}/learning").awaitTermination()

    rows = spark.createDataFrame(ROWS, SCHEMA)
    rows.where("doc_id < 3").coalesce(1).write.json(landed)
    learn()
    assert set(predicted(classify(rows, "doc_id", counts_so_far(spark, model))).values()) == {"sport"}
    rows.where("doc_id >= 3").repartition(2).write.mode("append").json(landed)
    learn()
    start_scoring_latest(stream(), "doc_id", model, out, f"{tmp_path}/scoring").awaitTermination()
    assert predicted(spark.read.parquet(f"{out}/*")) == by_hand(ROWS, ROWS)


def test_nothing_learned(spark, tmp_path):
    rows = spark.createDataFrame(ROWS, SCHEMA)
    learn_batch(rows.where("category IS NULL"), f"{tmp_path}/m", 0)
    assert set(predicted(classify(rows, "doc_id", counts_so_far(spark, f"{tmp_path}/m"))).values()) == {None}
    with pytest.raises(Exception):
        counts_so_far(spark, f"{tmp_path}/absent").collect()


def test_scoring_shuffles_terms_of_blocks_and_no_postings(spark):
    rows = spark.createDataFrame(ROWS * 20, SCHEMA).repartition(2)
    learned = spark.createDataFrame([(c, t, 1) for c in "xy" for t in (None, "goal", "vote")], "category string, term string, n long")
    plan = classify(rows, "doc_id", learned)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan
