import hashlib
import math
import zlib
from collections import Counter, defaultdict

import pytest

from pressroom.llm.rendezvous import even, growth, number, place, shard_query, write_shards


def by_hand(key, weights):
    name = "n" if key is None else f"k{key}"

    def draw(shard):
        digest = hashlib.md5(f"{name}/{shard}".encode()).hexdigest()[:13]
        return -math.log((int(digest, 16) + 0.5) / 16 ** 13) / weights[shard], shard

    return min(draw(s) for s in weights)[1]


def test_places_as_by_hand(spark):
    weights = {0: 1.0, 3: 2.0, 4: 0.5}
    rows = spark.createDataFrame([(f"id{i}",) for i in range(500)] + [(None,), ("",)], "key string")
    placed = place(rows, "key", weights, {**weights, 9: 1.0}).collect()
    assert {(r.key, r.shard, r.grown_shard) for r in placed} == {
        (r.key, by_hand(r.key, weights), by_hand(r.key, {**weights, 9: 1.0})) for r in placed}
    assert [r.shard for r in place(rows, "key", weights).collect()] == [r.shard for r in placed]


def test_weights_and_growth(spark):
    rows = spark.range(40_000).withColumnRenamed("id", "key")
    weights = {0: 1.0, 1: 1.0, 2: 2.0}
    moves = {(r.shard, r.grown_shard): r.rows for r in growth(place(rows, "key", weights, {**weights, 3: 1.0})).collect()}
    share = Counter()
    for (shard, _), n in moves.items():
        share[shard] += n / 40_000
    assert share[0] == pytest.approx(0.25, abs=0.01) and share[2] == pytest.approx(0.5, abs=0.01)
    assert all(later in (now, 3) for now, later in moves)
    assert sum(n for (now, later), n in moves.items() if now != later) / 40_000 == pytest.approx(0.2, abs=0.01)


def test_slots_are_gapless_with_a_hot_key(spark):
    rows = spark.createDataFrame(
        [(7, i % 3, "x") for i in range(3000)] + [(None, 0, "x")] * 50 + [(i, 0, "x") for i in range(500)],
        "key long, slot int, shard string").repartition(5)
    numbered = number(place(rows, "key", even(4)), ["key"]).collect()
    assert len(numbered) == 3550
    slots = defaultdict(list)
    for r in sorted(numbered, key=lambda r: r.slot):
        slots[r.shard].append(r)
    for shard, own in slots.items():
        assert [r.slot for r in own] == list(range(len(own)))
        keys = [-1 if r.key is None else r.key for r in own]
        assert keys == sorted(keys)
    assert len({r.shard for r in numbered if r.key == 7}) == 1


def test_query_on_odd_rows(odd, none):
    rows = shard_query(odd).collect()
    assert len(rows) == odd.count()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.size, r.text_crc32) for r in rows) == sorted(
        (-1 if r.doc_id is None else r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode()))
        for r in odd.collect())
    assert {r.law for r in rows} == {"key"}
    assert all(r.shard == by_hand(r.doc_id, even(8)) and r.grown_shard == by_hand(r.doc_id, even(9)) for r in rows)
    assert shard_query(none).count() == 0


def test_written_shards(spark, odd, tmp_path):
    write_shards(odd, f"{tmp_path}/out", "doc_id", even(3))
    back = spark.read.parquet(f"{tmp_path}/out")
    assert back.count() == odd.count()
    assert back.where("shard = 1").count() == odd.count() - back.where("shard <> 1").count()


def test_wrong_weights(odd):
    for weights in ({}, {0: 0.0}, {0: -1.0}):
        with pytest.raises(ValueError):
            place(odd, "doc_id", weights)
    with pytest.raises(ValueError):
        place(odd, "doc_id", even(3), even(2))
