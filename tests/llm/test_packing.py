import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PythonException
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pressroom.llm import packing
from pressroom.llm.packing import best_fit, cut_documents, pack, packing_query

PATH = public_tokenizers.path("byte_bpe_50k.json")


@settings(deadline=None, max_examples=60)
@given(st.lists(st.integers(1, 50), max_size=80))
def test_best_fit_is_gapless_and_tight(lengths):
    bins, offsets = best_fit(np.array(lengths, np.int64), 50)
    fills = {}
    for b, o, n in sorted(zip(bins.tolist(), offsets.tolist(), lengths)):
        assert o == fills.get(b, 0)
        fills[b] = o + n
    assert all(f <= 50 for f in fills.values())
    assert sum(f <= 25 for f in fills.values()) <= 1


def places_are_right(rows, capacity):
    by_bin = {}
    for r in rows:
        by_bin.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for items in by_bin.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_bin)


@pytest.fixture
def many_tasks(spark):
    """Small shuffles keep their eight tasks."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_open_bins_of_many_tasks_are_merged(spark, monkeypatch, many_tasks):
    monkeypatch.setattr(packing, "FAN_IN", 2)
    items = spark.range(0, 3000, 1, 16).select("id", (F.pmod(F.xxhash64("id"), F.lit(900)) + 1).alias("length"))
    rows = pack(items, capacity=2048).collect()
    assert len(rows) == 3000
    total = sum(r["length"] for r in rows)
    assert places_are_right(rows, 2048) <= total / 2048 * 1.02 + 1


@pytest.mark.parametrize("round_items", [200_000, 300])
def test_items_ordered_by_length(spark, monkeypatch, many_tasks, round_items):
    """Nearly as few bins as one best fit over all, also where no task may take all open bins."""
    monkeypatch.setattr(packing, "ROUND_ITEMS", round_items)
    lengths = np.sort(np.random.default_rng(1).integers(900, 2000, 12_000))
    items = spark.createDataFrame([(i, int(n)) for i, n in enumerate(lengths)], "id long, length long").coalesce(1)
    items = items.repartitionByRange(16, "id")
    best = best_fit(lengths, 2048)[0].max() + 1
    assert places_are_right(pack(items, capacity=2048).collect(), 2048) <= best * 1.01


def test_many_open_bins_stay_in_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(packing, "ROUND_ITEMS", 50)
    items = spark.range(0, 400, 1, 8).select("id", F.lit(1500).cast("long").alias("length"))
    rows = pack(items, capacity=2048).collect()
    assert places_are_right(rows, 2048) == 400


def test_pieces_are_those_of_the_tokenizer(odd):
    tokenizer = Tokenizer.from_file(PATH)
    rows = packing_query(odd.select("doc_id", "text"), PATH).collect()
    places_are_right(rows, 2048)
    cut = {}
    for r in cut_documents(odd, PATH).collect():
        cut.setdefault(r["doc_id"], []).append(r)
    texts = {}
    for r in odd.collect():
        texts.setdefault(r["doc_id"], []).append(r["text"] or "")
    for key, group in texts.items():
        expected = sorted(tokenizer.encode(t, add_special_tokens=False).ids + [0] for t in group)
        pieces = sorted(cut[key], key=lambda r: (r["piece"], r["ids"]))
        if len(group) == 1:
            ids = b"".join(r["ids"] for r in pieces)
            assert np.frombuffer(ids, "<u4").tolist() == expected[0]
            assert all(r["length"] == 2048 for r in pieces[1:])
            assert [r["start"] for r in pieces] == np.cumsum([0, *(r["length"] for r in pieces[:-1])]).tolist()
        else:
            assert sorted(np.frombuffer(r["ids"], "<u4").tolist() for r in pieces) == expected


def test_other_columns_are_carried(spark):
    items = spark.createDataFrame([(1, 5, "a", 9), (1, 5, "a", 9)], "id int, length int, bin string, offset int")
    rows = pack(items, capacity=10).collect()
    assert sorted(r["offset"] for r in rows) == [0, 5] and {r["bin"] for r in rows} == {"a"}
    assert len({r["sequence_id"] for r in rows}) == 1


def test_no_rows(none):
    assert packing_query(none.select("doc_id", "text"), PATH).count() == 0


@pytest.mark.parametrize("length", [0, 11, None])
def test_lengths_out_of_range_are_refused(spark, length):
    with pytest.raises(PythonException, match="lengths must be"):
        pack(spark.createDataFrame([(length,)], "length long"), capacity=10).collect()


def test_joined_words_are_cut_where_they_were(monkeypatch):
    """Words encoded as one text give each its own ids, whatever stands between them."""
    monkeypatch.setattr(packing, "JOINED", 7)
    texts = ["plain words, some 12 345 numbers ... and -- signs; it's they'll  two   spaces\n\nlines\t tabs",
             " ünï çødé 日本 語 😀 😀😀 é\u0301 x\u00a0y z\u2003w \x1c \x1fq \u0085 v", "a b c d e f g h i j k l m n o p q r s t"]
    tokenizer = Tokenizer.from_file(PATH)
    got = packing._token_bytes(PATH, texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [
        tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
