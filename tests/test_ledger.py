import json

import pytest
from pyspark.sql import functions as F

from pressroom.schemas import ARTICLE_FIELDS
from pressroom.sources import ledger
from pressroom.sources.ledger import commit_batch, compact, read_rejects, scan_articles, vacuum
from pressroom.sources.messages import stream_message_files
from pressroom.streaming.ingest import start_ledger_ingest


def messages(spark, *values):
    rows = [(v if v is None or isinstance(v, str) else json.dumps(v),) for v in values]
    return spark.createDataFrame(rows, "value string")


def texts(spark, root, equals=None):
    return sorted((r["text"], r["category"], r["title"]) for r in scan_articles(spark, root, equals).collect())


def rejects(spark, root):
    return sorted((r["reason"], r["value"]) for r in read_rejects(spark, root).collect())


A, B, C = ({"text": t, "category": k} for t, k in (("a", "x"), ("b", "y"), ("c", None)))
WIDE = {"text": "a", "category": "x", "title": "t"}


def test_batches_replays_and_known_articles(spark, tmp_path):
    root = str(tmp_path)
    assert texts(spark, root) == [] and rejects(spark, root) == []
    assert commit_batch(messages(spark, [A, A, C], "no", None), root, 0)
    assert not commit_batch(messages(spark, [B], "again"), root, 0)  # known by its number
    assert commit_batch(messages(spark, [A, B], [{}]), root, 1)
    assert commit_batch(messages(spark, [WIDE, {"title": "t"}]), root, 3)  # wider than what is stored
    assert commit_batch(messages(spark, [{"title": "t"}, A]), root, 0, source="other")  # both answered
    expected = [("a", "x", None), ("a", "x", "t"), ("b", "y", None), ("c", None, None)]
    key = lambda r: tuple(v or "" for v in r)
    found = [tuple(r) for r in scan_articles(spark, root).select("text", "category", "title").collect()]
    assert sorted(found, key=key) == expected
    assert {r["reason"]: r["value"] for r in read_rejects(spark, root).collect()} == {"null": None, "not a list": "no"}
    assert scan_articles(spark, root).columns == list(ARTICLE_FIELDS)
    assert scan_articles(spark, root, {"category": None}).first()["text"] == "c"


def test_a_failure_leaves_no_half_batch(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    commit_batch(messages(spark, [A], "no"), root, 0)

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(ledger, "_record", fail)
        with pytest.raises(OSError):
            commit_batch(messages(spark, [A, B], "bad"), root, 1)
    assert texts(spark, root) == [("a", "x", None)] and rejects(spark, root) == [("not a list", "no")]
    assert commit_batch(messages(spark, [A, B], "bad"), root, 1)
    assert texts(spark, root) == [("a", "x", None), ("b", "y", None)]
    assert rejects(spark, root) == [("not a list", "bad"), ("not a list", "no")]
    assert vacuum(spark, root) == 1 and len(texts(spark, root)) == 2


def many(spark, start, end):
    rows = spark.range(start, end).select(F.to_json(F.array(F.struct(
        F.concat(F.lit("text "), "id").alias("text"), F.concat(F.lit("k"), F.col("id") % 10).alias("category")))).alias("value"))
    return rows


def test_a_batch_opens_only_prefixes_it_may_hit(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    monkeypatch.setattr(ledger, "KEYS_PER_PREFIX", 50)
    commit_batch(many(spark, 0, 3000), root, 0)
    every = len(list((tmp_path / "keys").glob("*/prefix=*")))
    assert every == 64
    from pressroom.operators.dedupe import with_match_keys
    from pressroom.sources.messages import decode_messages

    def asked(df):
        return with_match_keys(decode_messages(df)).select(F.col("asks").alias("key"))

    old, new = asked(many(spark, 100, 105)), asked(many(spark, 9000, 9100))
    assert len(ledger._key_paths(spark, root, old)) == len({bytes(r["key"])[0] // 4 for r in old.collect()})
    assert len(ledger._key_paths(spark, root, new)) <= 5  # a new key passes its filter once in thousands
    found = ledger.known_keys(spark, root, old.unionByName(new))
    assert len(found.inputFiles()) < 20 and found.count() == 5


def test_several_filters_for_a_prefix(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ledger, "BITS_PER_KEY", 100)
    root = str(tmp_path)
    commit_batch(many(spark, 0, 800), root, 0)
    assert {(r["prefixes"], r["buckets"]) for r in ledger._attempts(ledger.read_ledger(spark, root))} == {(1, 4)}
    monkeypatch.undo()
    commit_batch(many(spark, 0, 820), root, 1)
    assert scan_articles(spark, root).count() == 820


def test_compaction_keeps_all_and_prunes_by_category(spark, tmp_path):
    root = str(tmp_path)
    for i in range(2):
        commit_batch(many(spark, 300 * i, 300 * i + 350), root, i)
    commit_batch(messages(spark, [C], "no"), root, 2)
    before = scan_articles(spark, root)  # begun before the compaction, read after it
    assert compact(spark, root, file_bytes=10_000) and not compact(spark, root)
    assert before.count() == 651 and scan_articles(spark, root).count() == 651
    assert rejects(spark, root) == [("not a list", "no")]
    whole, one = scan_articles(spark, root), scan_articles(spark, root, {"category": "k3"})
    assert one.count() == 65 and len(one.inputFiles()) < len(whole.inputFiles())
    assert scan_articles(spark, root, {"category": None}).count() == 1
    assert texts(spark, root, {"category": "none"}) == []
    assert vacuum(spark, root) == 3 and scan_articles(spark, root).count() == 651
    commit_batch(many(spark, 0, 660), root, 4)  # keys were carried over
    assert scan_articles(spark, root).count() == 661
    assert not commit_batch(many(spark, 700, 701), root, 1)  # so were the numbers


def test_stream(spark, tmp_path):
    landed, root = tmp_path / "landed", str(tmp_path / "store")
    landed.mkdir()
    for i, lines in enumerate([[[A, A]], [[A, B], "bad"]]):
        (landed / f"{i}.json").write_text("".join(json.dumps(x) + "\n" for x in lines))
    for run in range(2):  # the second run comes from a fresh checkpoint, with another source
        start_ledger_ingest(
            stream_message_files(spark, str(landed), max_files=1), root, str(tmp_path / f"c{run}"), f"s{run}",
        ).awaitTermination(120)
        assert scan_articles(spark, root).count() == 2
    assert read_rejects(spark, root).count() == 2  # each source's own


def test_landed_files_are_bounded():
    """However large the input, no task deals out more than one small file of it."""
    import __spark_entry__ as entry

    for size in (0, 1, 10**8, 10**9, 6 * 10**9, 10**12):
        files = 3 * entry.landed_files(size)
        assert files % 3 == 0 and size / files <= entry._LANDED_BYTES
