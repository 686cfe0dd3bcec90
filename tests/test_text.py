import pytest
from pyspark.sql import functions as F

from pressroom.functions.text import compose_text, lower_text, with_clean_text
from pressroom.functions.tokens import (
    ENGLISH_STOP_WORDS,
    FEED_STOP_WORDS,
    gap_tokenizer,
    match_tokenizer,
    stop_word_remover,
    term_counts,
)


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "text string")


@pytest.mark.parametrize(
    "raw, clean",
    [
        ("a<b>x</b>y>z", "axy>z"),
        ("a<b\nc>d", "ad"),
        ("a<b<c>d", "ad"),
        ("&lt;p&gt; stays", "&lt;p&gt; stays"),
        ("<>", ""),
    ],
)
def test_strip(spark, raw, clean):
    assert with_clean_text(texts(spark, raw), "text").first()["text"] == clean


def test_unclosed_tag_and_null_are_left_out(spark):
    df = texts(spark, "open < tag", None, "fine")
    assert [r["text"] for r in with_clean_text(df, "text").collect()] == ["fine"]


def test_compose_has_no_separator_and_null_wins(spark):
    df = spark.createDataFrame([("T1", "D1"), ("T2", None)], "t string, d string")
    got = [r[0] for r in df.select(compose_text(F.col("t"), F.col("d"))).collect()]
    assert got == ["T1D1", None]


def test_lower_is_unicode(spark):
    assert texts(spark, "ÉCOLE").select(lower_text(F.col("text"))).first()[0] == "école"


def test_gap_tokens_and_feed_stop_words(spark):
    df = gap_tokenizer().transform(texts(spark, "Café the t-shirt costs HTTP don't"))
    df = stop_word_remover(FEED_STOP_WORDS).transform(df)
    row = df.first()
    assert row["words"] == "caf the t shirt costs http don t".split()
    assert row["filtered"] == "caf shirt costs don".split()


def test_match_tokens(spark):
    df = match_tokenizer().transform(texts(spark, "Café don't 日本 x_1"))
    assert df.first()["words"] == "café don t 日本 x_1".split()


def test_english_list():
    assert len(ENGLISH_STOP_WORDS) == 179 == len(set(ENGLISH_STOP_WORDS))


def test_term_counts_matches_a_plain_count(spark):
    values = ["b a b", "", "x", "a a a a", "c b a"]
    df = texts(spark, *values).withColumn("words", F.filter(F.split("text", " "), lambda w: w != ""))
    got = {
        r["text"]: None if r["c"] is None else {p["term"]: p["n"] for p in r["c"]}
        for r in df.select("text", term_counts(F.col("words")).alias("c")).collect()
    }
    from collections import Counter

    for v in values:
        assert got[v] == (dict(Counter(v.split())) or None)
