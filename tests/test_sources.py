import json

import pytest
from pyspark.sql import functions as F

from pressroom.schemas import ARTICLE_FIELDS, SEARCH_FIELDS
from pressroom.sources import catalog, feeds, messages, requests, search, store


def test_catalogs_flatten_in_order(spark):
    total = 0
    for publisher in catalog.PUBLISHERS.values():
        flat = catalog.flatten_catalog(catalog.catalog_frame(spark, publisher)).collect()
        total += len(flat)
    assert total == 29
    nyt = catalog.flatten_catalog(catalog.catalog_frame(spark, catalog.NEW_YORK_TIMES))
    films = nyt.where("category = 'entertainment'").orderBy("position").collect()
    assert [r["url"] for r in films] == catalog.NEW_YORK_TIMES["entertainment"]


def test_catalog_json_takes_one_url_or_a_list(spark):
    df = spark.createDataFrame([('{"a": "u1", "b": ["u2", "u3"]}',)], "body string")
    got = {r["category"]: r["urls"] for r in catalog.parse_catalog(df, "body").collect()}
    assert got == {"a": ["u1"], "b": ["u2", "u3"]}


FEED = """<?xml version="1.0"?><rss><channel><title>Feed</title>
<item><title>T1</title><description>&lt;p&gt;D1&lt;/p&gt;</description></item>
<item><title>T2</title></item>
<item><title>T3</title><description><![CDATA[<b>D3</b> &amp; x]]></description></item>
<item><title>T4</title><description>open &lt; tag</description></item>
<item><title>T5</title><description></description></item>
<item><title>T6</title><title>other</title><description>D6</description></item>
</channel></rss>"""
ARTICLES = {"T1D1", "T3D3 &amp; x", "T5", "T6D6"}


def test_feed_column(spark):
    one_item = "<rss><channel><item><title>A</title><description>B</description></item></channel></rss>"
    df = spark.createDataFrame(
        [(FEED, "tech"), ("<rss><channel><item>", "bad"), (one_item, "one"), (None, "null")],
        "body string, category string",
    )
    got = feeds.feed_articles(df, "body", "category").collect()
    assert {r["text"] for r in got if r["category"] == "tech"} == ARTICLES
    assert [r["text"] for r in got if r["category"] != "tech"] == ["AB"]


def test_messages_are_bounded_by_bytes(spark):
    df = spark.range(100).select(F.repeat(F.lit("x"), 120_000).alias("text"), F.lit("c").alias("category")).coalesce(1)
    sizes = [len(r["value"]) for r in messages.encode_messages(df).collect()]
    assert len(sizes) == 13 and max(sizes) <= messages.MESSAGE_BYTES
    alone = messages.encode_messages(df, max_bytes=1000)
    assert alone.count() == 100 == messages.oversize(alone, 1000).count()
    assert messages.decode_messages(alone).count() == 100


def test_rejects(spark):
    df = spark.createDataFrame([("a", "[]"), ("b", "{}"), ("c", "[{"), ("d", None), ("e", '[{"text": "t"}]')], "k string, value string")
    assert {r["k"]: r["reason"] for r in messages.rejected_messages(df).collect()} == {
        "b": "not a list", "c": "not JSON", "d": "null"}
    good, bad = "<item><title>A</title><description>b</description></item>", "<item><title>A & B</title></item>"
    df = spark.createDataFrame([("a", good + bad), ("b", "<rss/>"), ("c", None), ("d", good)], "k string, body string")
    got = {(r["k"], r["item"], r["reason"]) for r in feeds.rejected_feeds(df, "body", "k").collect()}
    assert got == {("a", bad, "malformed"), ("b", None, "no item"), ("c", None, "no item")}


def test_feed_items_anywhere(spark):
    def item(title, more=""):
        return f"<item><title>{title}</title><description>d{more}</description></item>"

    long = "x" * 200_000
    bodies = [
        ("two", f"<rss><channel>{item('A')}</channel><channel>{item('B')}</channel></rss>"),
        ("beside", f"<rdf><channel/>{item('C')}<item />{item('D')}</rdf>"),
        ("deep", f"<rss><channel><group>{item('E')}</group></channel></rss>"),
        ("broken", f"<rss><channel>{item('F')}{item('G & H')}{item('I')}</channel></rss>"),
        ("cdata", f"<rss><channel>{item('J', '<![CDATA[</item> <b>]]>')}{item('K', long)}</channel></rss>"),
    ]
    df = spark.createDataFrame(bodies, "category string, body string")
    got = sorted((r["category"], r["text"][:2]) for r in feeds.feed_articles(df, "body", "category").collect())
    assert got == [("beside", "Cd"), ("beside", "Dd"), ("broken", "Fd"), ("broken", "Id"), ("cdata", "Jd"),
                   ("cdata", "Kd"), ("deep", "Ed"), ("two", "Ad"), ("two", "Bd")]


def test_feed_files(spark, tmp_path):
    (tmp_path / "tech.xml").write_text(FEED)
    (tmp_path / "world.xml").write_text(FEED.replace("T1", "W1"))
    got = feeds.read_feed_catalog(
        spark, {"tech": [str(tmp_path / "tech.xml")], "world": [str(tmp_path / "world.xml")]}
    ).collect()
    assert {r["text"] for r in got if r["category"] == "tech"} == ARTICLES
    assert "W1D1" in {r["text"] for r in got if r["category"] == "world"}
    assert got[0].asDict().keys() == {"text", "category"}


def response(*articles):
    return json.dumps({"status": "ok", "page_size": len(articles), "articles": list(articles)})


def article(n, **changes):
    return {f: f"{f}{n}" for f in SEARCH_FIELDS} | {"extra": 1} | changes


def test_search_is_all_or_nothing(spark):
    lacking = article(9)
    del lacking["link"]
    df = spark.createDataFrame(
        [
            ("q1", response(article(1), article(2, media=None))),
            ("q2", response(article(3), lacking)),
            ("q3", response()),
            ("q4", "not json"),
            ("q5", '{"status": "error"}'),
        ],
        "query string, body string",
    )
    rows = search.search_articles(df, "body", "query").orderBy("title").collect()
    assert [(r["query"], r["title"], r["media"]) for r in rows] == [
        ("q1", "title1", "media1"), ("q1", "title2", None),
    ]
    assert rows[0].asDict().keys() == {"query", *SEARCH_FIELDS}
    groups = search.search_groups(df, "body", "query").collect()
    assert [(r["query"], len(r["articles"])) for r in groups] == [("q1", 2)]


def test_search_field_option(spark):
    df = spark.createDataFrame([(json.dumps({"hits": [article(1)]}),)], "body string")
    assert search.search_articles(df, "body", field="hits").count() == 1


def test_request_plan_of_the_configured_requests(spark, tmp_path):
    (tmp_path / "config.json").write_text(requests.request_config())
    plan = requests.request_plan(
        requests.read_request_config(spark, str(tmp_path / "config.json")), "body"
    ).collect()
    assert len(plan) == 48
    assert {r["output_name"] for r in plan} == {f"{j}-{i}.json" for j in range(1, 9) for i in range(6)}
    assert {r["query_string"]["country"] for r in plan} == {"US"}
    assert len({r["query_string"]["topic"] for r in plan}) == 7
    assert {r["api_limit"] for r in plan} == {None, 50}
    assert all(r["header_names"] == ["X-RapidAPI-Key", "X-RapidAPI-Host"] for r in plan)


def test_request_plan_without_a_whole_hit_is_empty(spark):
    config = {"RapidAPI": {"k": {"api": [{"url": "u"}] * 5, "MaxAPIS": 3}}}
    df = spark.createDataFrame([(json.dumps(config),)], "body string")
    assert requests.request_plan(df, "body").count() == 0


def test_archive_keys_and_quarantine(spark):
    paths = ["./Data/2019-7.json", "./Data/2019.json", "2020-1", "a/1-2-3.json"]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    good = requests.archive_keys(df, "path").orderBy("year").collect()
    assert [(r["year"], r["month"]) for r in good] == [("2019", "7"), ("2020", "1")]
    assert good[0]["request_url"] == "https://api.nytimes.com/svc/archive/v1/2019/7.json"
    assert requests.signed(good[0]["request_url"], "KEY").endswith("/2019/7.json?api-key=KEY")
    assert good[0]["output_name"] == "./Data/NYTimeData/2019-7.json"
    bad = {r["path"] for r in requests.archive_quarantine(df, "path").collect()}
    assert bad == {"./Data/2019.json", "a/1-2-3.json"}


def test_messages_round_trip(spark):
    rows = [(i, f'text "{i}"\nline', None if i % 3 else "c") for i in range(25)]
    df = spark.createDataFrame(rows, "id long, text string, category string").coalesce(1)
    encoded = messages.encode_messages(df, batch_size=10)
    values = [json.loads(r["value"]) for r in encoded.collect()]
    assert [len(v) for v in values] == [10, 10, 5]
    assert values[0][1] == {"text": 'text "1"\nline'}
    back = messages.decode_messages(encoded)
    assert back.columns == list(ARTICLE_FIELDS)
    got = {(r["text"], r["category"]) for r in back.collect()}
    assert got == {(t, c) for _, t, c in rows}
    assert "Exchange" not in encoded._jdf.queryExecution().executedPlan().toString()


def test_messages_with_explicit_nulls_and_of_nothing(spark):
    df = spark.createDataFrame([("a", "x"), ("b", None)], "text string, category string").coalesce(1)
    value = messages.encode_messages(df, keep_nulls=True).first()["value"]
    assert json.loads(value) == [
        {"text": "a", "category": "x"}, {"text": "b", "category": None},
    ]
    assert messages.encode_messages(df.limit(0)).count() == 0


def test_a_search_is_a_message(spark):
    df = spark.createDataFrame([(response(article(1), article(2, media=None)),), (response(),)], "body string")
    sent = messages.encode_groups(search.search_groups(df, "body"))
    assert [[a["media"] for a in json.loads(r["value"])] for r in sent.collect()] == [["media1", None]]
    assert messages.decode_messages(sent).count() == 2


def test_bad_messages_yield_nothing(spark):
    df = spark.createDataFrame(
        [("not json",), ('{"text": "a"}',), ("[",), ("[]",), (' [{"text": "ok"}]',), (None,)],
        "value string",
    )
    assert [r["text"] for r in messages.decode_messages(df).collect()] == ["ok"]


def test_message_files(spark, tmp_path):
    df = spark.createDataFrame([("a\nb", "c")], "text string, category string")
    messages.write_message_files(messages.encode_messages(df), str(tmp_path / "m"))
    back = messages.decode_messages(messages.read_message_files(spark, str(tmp_path / "m")))
    assert back.first()["text"] == "a\nb"


def test_project_fill(spark):
    df = spark.createDataFrame(
        [("a", 0, False, []), (None, 5, True, [1]), ("", None, None, None)],
        "s string, n int, b boolean, l array<int>",
    )
    got = [tuple(r) for r in store.project_fill(df, ("n", "s", "b", "l")).collect()]
    assert got == [("", "a", "", ""), ("5", "", "true", "[1]"), ("", "", "", "")]
    with pytest.raises(KeyError):
        store.project_fill(df, ("absent",))


def test_training_frame_of_a_mixed_store(spark):
    df = spark.createDataFrame(
        [("t", None, None, None), (None, None, "s", "p")],
        "text string, category string, summary string, topic string",
    )
    assert [tuple(r) for r in store.training_frame(df).collect()] == [("t", "")]
    both = {tuple(r) for r in store.training_frame(df, include_search=True).collect()}
    assert both == {("t", ""), ("s", "p")}


def test_matching(spark):
    df = spark.createDataFrame([("a", "x"), ("b", None)], "text string, category string")
    assert store.matching(df, {}).count() == 2
    assert store.matching(df, {"category": "x"}).first()["text"] == "a"
    assert store.matching(df, {"category": None}).first()["text"] == "b"


def test_csv_drops_rows_with_missing_cells(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('text,category\n"a ""q"", b\nc",x\n,y\nd,\n"",z\nNA,w\ne,nan\nf,ok\n')
    got = {tuple(r) for r in store.read_training_csv(spark, str(path)).collect()}
    assert got == {('a "q", b\nc', "x"), ("f", "ok")}


def test_metric_file(spark, tmp_path):
    df = spark.createDataFrame([(0.4, 0.1, 0.2, 0.3)], "f1 double, accuracy double, precision double, recall double")
    for _ in range(2):
        store.write_metrics(df, str(tmp_path / "m"))
    lines = [l for f in (tmp_path / "m").glob("*.csv") for l in f.read_text().splitlines()]
    assert lines == ["0.1,0.2,0.3,0.4"]


def test_kafka_needs_its_connector(spark, tmp_path):
    with pytest.raises(Exception, match="kafka"):
        messages.stream_topic(spark, "nowhere:9092")
    one = spark.createDataFrame([("[]",)], "value string")
    with pytest.raises(Exception, match="kafka"):
        messages.write_topic(one, "nowhere:9092")


def test_messages_of_a_stream(spark, tmp_path):
    articles = spark.createDataFrame([("a", "x"), ("b", "y")], "text string, category string").coalesce(1)
    articles.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(articles.schema).parquet(str(tmp_path / "in"))
    (
        messages.encode_messages(stream).writeStream.format("text")
        .option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True).start().awaitTermination(120)
    )
    back = messages.decode_messages(messages.read_message_files(spark, str(tmp_path / "out")))
    assert {r["text"] for r in back.collect()} == {"a", "b"}


def test_request_plan_without_apis_is_empty(spark):
    df = spark.createDataFrame([('{"RapidAPI": {"k": {"api": [], "MaxAPIS": 3}}}',)], "body string")
    assert requests.request_plan(df, "body").count() == 0


def test_nothing_is_parsed_twice(spark):
    df = spark.createDataFrame([("[]",)], "value string")
    for frame, parser in [
        (messages.decode_messages(df), "from_json"),
        (search.search_articles(df, "value"), "from_json"),
        (search.search_groups(df, "value"), "from_json"),
        (feeds.feed_articles(df, "value"), "from_xml"),
    ]:
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert sum(parser in line for line in plan.splitlines()) == 1, plan


def test_messages_are_joined_a_few_at_a_time(spark, monkeypatch):
    """The messages are the same, and a worker's batches are small however many rows it is given."""
    df = spark.range(0, 3000, 1, 1).select(F.concat(F.lit("x" * 50), F.col("id").cast("string")).alias("text"))
    whole = [r["value"] for r in messages.encode_messages(df, batch_size=7, max_bytes=400).collect()]
    sizes = _batch_sizes(messages.encode_messages(df, batch_size=7, max_bytes=400))
    assert len(sizes) == 1
    monkeypatch.setattr(messages, "JOINED_BYTES", 2000)
    few = messages.encode_messages(df, batch_size=7, max_bytes=400)
    assert [r["value"] for r in few.collect()] == whole
    sizes = _batch_sizes(messages.encode_messages(df, batch_size=7, max_bytes=400))
    assert len(sizes) > 50 and max(sizes) < 3000
    assert messages.encode_messages(df.limit(0)).count() == 0


def _batch_sizes(encoded):
    """Bytes of the batches that the encoder gives, run on its rows without Spark between."""
    import pyarrow as pa

    plan = encoded.toArrow()
    rows = [json.dumps(a, separators=(",", ":")) for v in plan["value"].to_pylist() for a in json.loads(v)]
    batch = pa.RecordBatch.from_arrays([pa.array(rows)], ["json"])
    return [sum(len(v) for v in b.column(0).to_pylist()) for b in messages.cut_messages(iter([batch]), 7, 400)]
