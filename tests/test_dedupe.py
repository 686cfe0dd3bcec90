import json

from pyspark.sql import functions as F

from pressroom.operators.combine import union_mixed, union_sources
from pressroom.operators.dedupe import append_unseen
from pressroom.schemas import ARTICLE, ARTICLE_FIELDS
from pressroom.sources.store import scan_store
from pressroom.sources.messages import stream_message_files
from pressroom.streaming.ingest import start_ingest

RSS_A = {"text": "a", "category": "x"}
RSS_B = {"text": "b", "category": None}
SEARCH = {"title": "t", "link": "l", "media": None}
BOTH = {"text": "a", "category": "x", "title": "t"}


def frame(spark, *articles):
    return spark.createDataFrame(
        [tuple(a.get(f) for f in ARTICLE_FIELDS) for a in articles], ARTICLE
    )


def stored(spark, path):
    return sorted(
        tuple(sorted((k, v) for k, v in r.asDict().items() if v is not None))
        for r in scan_store(spark, path).collect()
    )


def items(*articles):
    return sorted(tuple(sorted((k, v) for k, v in a.items() if v is not None)) for a in articles)


def test_batches_and_replay(spark, tmp_path):
    path = str(tmp_path / "store")
    assert scan_store(spark, path).count() == 0
    append_unseen(frame(spark, RSS_A, RSS_A, RSS_B), path)
    append_unseen(frame(spark, RSS_A, SEARCH), path)
    assert stored(spark, path) == items(RSS_A, RSS_B, SEARCH)
    append_unseen(frame(spark, SEARCH, RSS_B, RSS_A), path)
    assert scan_store(spark, path).count() == 3


def test_a_stored_superset_answers_but_not_the_reverse(spark, tmp_path):
    path = str(tmp_path / "store")
    append_unseen(frame(spark, BOTH), path)
    append_unseen(frame(spark, RSS_A, {"title": "t"}), path)
    assert stored(spark, path) == items(BOTH)

    path = str(tmp_path / "other")
    append_unseen(frame(spark, RSS_A), path)
    append_unseen(frame(spark, BOTH), path)
    assert stored(spark, path) == items(RSS_A, BOTH)


def test_wider_article_of_the_same_batch_answers(spark, tmp_path):
    path = str(tmp_path / "store")
    append_unseen(frame(spark, RSS_A, BOTH, SEARCH), path)
    assert stored(spark, path) == items(BOTH, SEARCH)


def test_rows_without_fields_are_left_out(spark, tmp_path):
    path = str(tmp_path / "store")
    append_unseen(frame(spark, {}, RSS_A), path)
    assert stored(spark, path) == items(RSS_A)


def test_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "store")
    append_unseen(frame(spark, RSS_A, RSS_B), path)
    df = scan_store(spark, path, {"category": "x"})
    assert [r["text"] for r in df.collect()] == ["a"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(category,x)" in plan


def test_store_text_is_not_read_to_find_known_articles(spark, tmp_path):
    from pressroom.operators.dedupe import fresh_keys, unseen, with_match_keys
    from pressroom.sources.store import open_store

    path = str(tmp_path / "store")
    append_unseen(frame(spark, RSS_A), path)
    rows = with_match_keys(frame(spark, RSS_B))
    plan = unseen(rows, fresh_keys(rows, open_store(spark, path)))
    scans = [
        line for line in plan._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        ).splitlines() if line.startswith("ReadSchema")
    ]
    assert scans == ["ReadSchema: struct<match_keys:array<binary>>"]


def test_stream_ingest(spark, tmp_path):
    landed, store = tmp_path / "landed", str(tmp_path / "store")
    landed.mkdir()
    files = [[RSS_A, RSS_A, RSS_B], [RSS_A, SEARCH], [SEARCH]]
    for i, articles in enumerate(files):
        (landed / f"{i}.json").write_text(json.dumps(articles) + "\n")
    (landed / "bad.json").write_text("not json\n")
    for run in range(2):  # the second run starts from a fresh checkpoint
        start_ingest(
            stream_message_files(spark, str(landed), max_files=1), store, str(tmp_path / f"c{run}")
        ).awaitTermination(120)
        assert stored(spark, store) == items(RSS_A, RSS_B, SEARCH)
    (landed / "new.json").write_text(json.dumps([{"text": "n"}]) + "\n")
    start_ingest(
        stream_message_files(spark, str(landed)), store, str(tmp_path / "c1")
    ).awaitTermination(120)
    assert stored(spark, store) == items(RSS_A, RSS_B, SEARCH, {"text": "n"})


def test_unions(spark):
    rss = spark.createDataFrame([("a", "x")], "text string, category string")
    search = spark.createDataFrame([("t", "s")], "title string, summary string")
    assert union_sources(rss, rss.select("category", "text")).where("text = 'a'").count() == 2
    mixed = union_mixed(rss, search)
    assert mixed.columns == list(ARTICLE_FIELDS)
    assert mixed.where(F.col("text").isNull()).first()["summary"] == "s"
