import json
import re

from pressroom.plans.predict import predict, predict_text
from pressroom.plans.train import load, train_from_store
from pressroom.sources.feeds import feed_articles
from pressroom.sources.messages import encode_messages, stream_message_files, write_message_files
from pressroom.sources.search import search_articles
from pressroom.schemas import SEARCH_FIELDS
from pressroom.streaming.ingest import start_ingest


def feed(topic, words):
    items = "".join(
        f"<item><title>{words[i % 4]} news</title>"
        f"<description>&lt;p&gt;{words[(i + 1) % 4]} and {words[i % 3]} number{i}&lt;/p&gt;</description></item>"
        for i in range(40)
    )
    return topic, f"<rss><channel>{items}</channel></rss>"


def test_feeds_to_store_to_model(spark, tmp_path):
    bodies = spark.createDataFrame(
        [feed("sports", "goal match team coach".split()), feed("tech", "chip code robot cloud".split())],
        "category string, body string",
    )
    landed, store = str(tmp_path / "landed"), str(tmp_path / "store")
    for _ in range(2):  # the same articles arrive twice
        write_message_files(encode_messages(feed_articles(bodies, "body", "category")), landed)
    start_ingest(stream_message_files(spark, landed), store, str(tmp_path / "cp")).awaitTermination(120)

    trained = train_from_store(spark, store, str(tmp_path / "m"), str(tmp_path / "metrics"))
    assert trained.metrics.first()["accuracy"] == 1.0
    assert trained.counts.agg({"n": "sum"}).first()[0] < 80
    model, labels = load(spark, str(tmp_path / "m"))
    assert {r["category"] for r in labels.collect()} == {"sports", "tech"}
    assert predict_text(spark, model, "The coach and the team") == "sports"
    assert predict_text(spark, model, "robot chip") == "tech"

    # Search articles are told by their summary, and have their topic to compare with.
    found = [
        {f: None for f in SEARCH_FIELDS} | {"summary": s, "topic": t}
        for s, t in [("a robot writes code", "tech"), ("one more goal in the match", "sports")]
    ]
    bodies = spark.createDataFrame([(json.dumps({"articles": found}),)], "body string")
    texts = search_articles(bodies, "body").withColumnRenamed("summary", "text")
    assert predict(model, texts).where("predicted = topic").count() == 2
    line = next((tmp_path / "metrics").glob("*.csv")).read_text().strip()
    assert [float(x) for x in line.split(",")] == [1.0] * 4


def test_every_oracle_has_a_query_and_reads_a_table():
    import __spark_entry__ as entry

    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(queries)
    tables = "documents conversations pages events orders labels".split()
    assert all(any(t in sql for t in tables) for sql in oracles.values())
    own = {n for n in queries if not re.match(r"op\d+_|pipeline$", n)}
    assert json.dumps(sorted(own - set(oracles))) == json.dumps(
        ["boosted_predict", "cross_validate", "grid_search", "leaderboard", "lr_predict", "rf_predict"]
    )
