import random
import zlib

import pytest
from llm_helpers import odd_texts, text
from pyspark.sql import functions as F

from pressroom.llm.toxicity import HALF, THRESHOLD, Model, fit, learned, tokens, toxicity_query, training_rows, with_toxicity

BAD = ["foul", "vile", "rotten", "scumbag"]


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(8)
    rows = []
    for i in range(600):
        words = text(i, 60).split()
        toxic = int(i % 5 == 0)
        for _ in range(3 * toxic):
            words[rng.randrange(60)] = rng.choice(BAD) + rng.choice(["", ".", "!!", "%%%"])
        rows.append((i, " ".join(words), toxic))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(3).cache()


def held_out(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def test_held_out_texts_are_told_apart(corpus):
    truth = {r["doc_id"]: r["toxic"] for r in corpus.collect()}
    rows = toxicity_query(corpus.select("doc_id", "text"), corpus.select("doc_id", "toxic")).collect()
    assert len(rows) == len(truth)
    for r in rows:
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) and r["held_out"] == held_out(r["doc_id"])
    own = [r for r in rows if r["held_out"]]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in own) >= 0.97 * len(own)


def test_held_out_labels_are_not_read(corpus):
    labels = corpus.select("doc_id", "toxic")
    other = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    docs = corpus.select("doc_id", "text")
    assert learned(docs, labels) == learned(docs, other)


def test_odd_texts_have_a_score(corpus, odd):
    model = learned(corpus.select("doc_id", "text"), corpus.select("doc_id", "toxic"))
    got = with_toxicity(odd.withColumn("toxicity", F.lit("mine")), model)
    assert got.columns == [*odd.columns, "toxicity"] and dict(got.dtypes)["toxicity"] == "double"
    rows = got.collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert r["toxicity"] == pytest.approx(model.score(r["text"]))
    assert {model.score(t) for t in (None, "", " \n")} == {model.score("")}
    assert tokens("Foul%%% vile!! x_y") == ["foul", "vile", "x", "y"]


def test_labels_that_teach_nothing(spark, none):
    docs = spark.createDataFrame(list(enumerate(odd_texts())), "doc_id long, text string")
    empty = spark.createDataFrame([], "doc_id long, toxic int")
    assert all(r["predicted"] == 0 for r in toxicity_query(docs, empty).collect())
    one = docs.select("doc_id", F.lit(0).alias("toxic"))
    assert all(r["predicted"] == 0 for r in toxicity_query(docs, one).collect())
    assert toxicity_query(none, empty).count() == 0


def test_training_rows_are_bounded_and_merge_labels(corpus, spark):
    labels = corpus.select("doc_id", "toxic").unionByName(
        spark.createDataFrame([(1, 1), (None, 1), (2, None)], "doc_id long, toxic int"))
    rows = training_rows(corpus.select("doc_id", "text"), labels, F.lit(True), rows=50)
    assert rows.count() == 50
    every = training_rows(corpus.select("doc_id", "text"), labels, F.lit(True))
    assert every.count() == 600 and every.where("toxic = 1").count() == 121


def test_a_fit_without_calibration_rows_is_the_share(corpus):
    rows = corpus.select("text", "toxic", F.lit(False).alias("calibration"))
    model = fit(rows)
    assert model.ratios == {} and model.score("foul") == pytest.approx(0.2, abs=1e-6)
    assert isinstance(model, Model)


@pytest.fixture(scope="module")
def mixed(spark):
    """Labelled texts with many words that chance puts into few of them, mostly toxic ones at times."""
    rng = random.Random(9)

    def word():
        return f"w{rng.randrange(rng.choice([200, 30_000]))}"

    rows = []
    for i in range(900):
        words = [word() for _ in range(rng.randrange(60, 300))]
        toxic = int(i % 8 == 0)
        for _ in range(3 * toxic):
            words[rng.randrange(len(words))] = rng.choice(BAD)
        rows.append((i, " ".join(words), toxic))
    clean = " ".join(word() for _ in range(100_000))
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return learned(frame.select("doc_id", "text"), frame.select("doc_id", "toxic")), clean.split()


@pytest.mark.parametrize("n", [20_000, 50_000, 100_000])
def test_long_clean_texts_stay_clean(mixed, n):
    model, clean = mixed
    for start in range(0, 100_000, n):
        assert model.score(" ".join(clean[start:start + n])) < THRESHOLD
    at = n // 2
    assert model.score(" ".join([*clean[:at], *BAD, *clean[at:n]])) >= THRESHOLD


def test_windows_cover_a_text(mixed):
    model, clean = mixed
    for n in (1, HALF, HALF + 1, 5 * HALF - 1, 5 * HALF):
        for at in (0, n // 2, n - 1):
            words = ["w1"] * n
            plain = model.features(" ".join(words))
            words[at] = "foul"
            assert all(a > b for a, b in zip(model.features(" ".join(words)), plain))


@pytest.mark.parametrize("phrase", ["zarkblorf", "go zark blorf now"])
def test_a_repeated_phrase_counts_by_its_texts(spark, phrase):
    rows = [(i, f"{phrase} {text(i, 60)}" if i % 5 == 0 else text(i, 60), int(i % 5 == 0)) for i in range(600)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = learned(frame.select("doc_id", "text"), frame.select("doc_id", "toxic"))
    assert all(word in model.ratios for word in phrase.split())
    for i, words, toxic in rows:
        if held_out(i):
            assert (model.score(words) >= THRESHOLD) == bool(toxic)
