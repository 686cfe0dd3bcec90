import base64
import random

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken

from pressroom.llm import pretokens
from pressroom.llm.bpe import Ranks, decode_documents, encode_documents, encode_words, merge_lanes, merge_one
from pressroom.llm.pretokens import PATTERN, Memo

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def ranks():
    return Ranks(PATH)


def noise(n, seed):
    rng = random.Random(seed)
    letters = " \t\n\r\x0b\x0c\x1c\x1f\x85\xa0　abcdeSTé'’sñßÀ×ªˁ˂²¼09٣#$–…日本😀​́\x00"
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(50))) for _ in range(n)]


def test_pattern_is_the_public_one():
    assert PATTERN == public_tokenizers.PATTERN


def test_fast_split_is_the_pattern():
    slow = regex.compile(PATTERN)
    for text in noise(3000, 1):
        assert [w for some in pretokens.pretokens(text) for w in some] == slow.findall(text)


def test_long_texts_are_split_piecewise(monkeypatch):
    monkeypatch.setattr(pretokens, "LONG_TEXT", 40)
    text = "".join(noise(60, 2))
    parts = list(pretokens.pretokens(text))
    assert len(parts) > 5 and max(map(len, parts)) <= 10 and "".join(w for p in parts for w in p) == text


def test_round_trip_and_ids(spark, odd, library):
    rows = [(i, t, 1) for i, t in enumerate([*noise(200, 3), None, "", "x" * 3000, "ab" * 20_000])]
    df = spark.createDataFrame(rows, "doc_id long, text string, token_ids int").unionByName(
        odd.select("doc_id", "text"), allowMissingColumns=True)
    got = decode_documents(encode_documents(df, PATH), PATH)
    assert got.columns == ["doc_id", "text", "token_ids", "decoded"]
    for r in got.collect():
        assert r["token_ids"] == library.encode_ordinary(r["text"] or "")
        assert r["decoded"] == (r["text"] or "").encode()


def test_lanes_merge_as_single_ones_do(ranks):
    rng = random.Random(5)
    for longest in (2, 9, 70, 256):
        words = [bytes(rng.choice(b"aabbcd \n") for _ in range(rng.randint(1, longest))) for _ in range(300)]
        assert [np.frombuffer(x, "<u4").tolist() for x in merge_lanes(ranks, words)] == [merge_one(ranks, w) for w in words]


def test_memo_forgets_without_error(ranks, monkeypatch):
    monkeypatch.setattr(pretokens, "MEMO_SIZE", 3)
    memo = Memo(lambda words: encode_words(ranks, words))
    for _ in range(3):
        for word in ("alpha", "beta", "gamma", "delta", "w" * 100):
            assert memo.joined([[[word, word]]]) == [2 * encode_words(ranks, [word])[0]]


def test_no_rows(none):
    assert decode_documents(encode_documents(none, PATH), PATH).count() == 0
