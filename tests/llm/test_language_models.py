"""The two language models over shards: exact counts, and probabilities that sum to one."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_helpers import odd_texts, text
from pyspark.sql import functions as F

from pressroom.llm import kneser_ney, pitman_yor, shards
from pressroom.llm.common import WORD
from pressroom.llm.kneser_ney import discounts, judge_quality, perplexities
from pressroom.llm.pitman_yor import pitman_yor_query, score_texts, seat
from pressroom.llm.shards import END, Layout


UPPER = {c: c + 32 for c in range(65, 91)}


def tokens(value):
    return [*re.findall(WORD, (value or "").translate(UPPER)), None]


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i, text(i % 60, 40 + i % 50)) for i in range(200)] + [(1000 + i, t) for i, t in enumerate(odd_texts())]
    rows += [(None, "alpha beta")]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3).cache()


def many_shards(monkeypatch, module):
    """A small corpus in several shards and chunks, with hot words."""
    hot = np.unique(np.array([END, shards._hash(b"alpha1"), shards._hash(b"beta2")], np.uint64))
    monkeypatch.setattr(module, "layout_for", lambda _: Layout(5, hot))
    monkeypatch.setattr(shards, "CHUNK_TOKENS", 3000)


@pytest.mark.parametrize("dealt", [False, True])
def test_base_scores_are_exact(corpus, dealt, monkeypatch):
    if dealt:
        many_shards(monkeypatch, pitman_yor)
    rows = {r["doc_id"]: r["text"] for r in corpus.collect()}
    held = {k: zlib.crc32(str(k).encode()) % 7 == 2 for k in rows if k is not None}
    train = Counter(w for k, t in rows.items() if k is not None and not held[k] for w in tokens(t))
    n, v = sum(train.values()), len(train)
    got = pitman_yor_query(corpus).collect()
    assert len(got) == len(rows)
    for r in got:
        words = tokens(rows[r["doc_id"]])
        assert r["n_tokens"] == len(words) and r["train_tokens"] == n
        assert r["n_known"] == sum(train[w] > 0 for w in words)
        assert r["base_score"] == pytest.approx(sum(math.log10((train[w] + 1) / (n + v + 1)) for w in words), rel=1e-9)
        assert r["held_out"] == held.get(r["doc_id"], True)
        assert r["score"] < 0
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)


def plain_scores(texts, layout):
    """The model in plain dicts, with the draws of the shards: scores of ``(key, text, train)``, and a function
    giving the mean probability of a word after another."""
    sequences = {key: [shards._hash(w.encode()) if w else END for w in tokens(t)] for key, t, _ in texts}
    bigrams = {key: list(zip([END, *s], s)) for key, s in sequences.items()}
    counts = Counter(p for key, _, train in texts if train for p in bigrams[key])
    words = {w for _, w in counts}
    hot = set(layout.hot.tolist())

    def shard_of(before, word):
        one = np.array([word], np.uint64), np.array([before >> 16], np.uint64)
        return int(layout.shard_of(*one)[0])

    places = {}
    for before, word in counts:
        places.setdefault(shard_of(before, word), []).append((word, before))
    seen = {}  # a shard's words, with those of texts that aren't learned from
    for s in bigrams.values():
        for before, word in s:
            seen.setdefault(shard_of(before, word), set()).add(word)
    tables = dict.fromkeys(counts, 1)
    own_customers = {(n, w): sum(1 for x, _ in p if x == w) for n, p in places.items() for w in {x for x, _ in p}}
    own_tables = dict.fromkeys(own_customers, 1)
    hot_tables = None
    kept = []
    for sweep in range(pitman_yor.SWEEPS + 1):
        customers, root_tables = Counter(), Counter()
        for (n, w), c in own_customers.items():
            customers[w] += c
            root_tables[w] += 0 if w in hot else own_tables[n, w]
        hot_customers = np.array([customers[w] for w in layout.hot.tolist()])
        if sweep == 0:
            hot_tables = (hot_customers > 0).astype(int)
        else:
            hot_tables = seat(
                hot_customers, np.full(len(hot_customers), base), pitman_yor.ROOT_DISCOUNT, np.random.default_rng(sweep))
        root_tables.update(dict(zip(layout.hot.tolist(), hot_tables.tolist())))
        base = (pitman_yor.ROOT_STRENGTH + pitman_yor.ROOT_DISCOUNT * sum(root_tables.values())) / (len(words) + 1)
        all_customers = sum(customers.values())
        of_context = Counter()
        for (before, _), t in tables.items():
            of_context[before] += t

        def root(w, customers=customers, root_tables=root_tables, base=base, n=all_customers):
            top = customers[w] - pitman_yor.ROOT_DISCOUNT * root_tables[w] + base
            return top / (pitman_yor.ROOT_STRENGTH + n)

        if sweep > pitman_yor.BURN_IN:
            kept.append((dict(tables), of_context, root))
        if sweep == pitman_yor.SWEEPS:
            break
        drawn = {}
        for n, there in seen.items():
            rng = np.random.default_rng((sweep, n))
            pairs = sorted(places.get(n, []))
            weight = [(pitman_yor.STRENGTH + pitman_yor.DISCOUNT * of_context[b]) * root(w) for w, b in pairs]
            t = seat(np.array([counts[b, w] for w, b in pairs], int), np.array(weight), pitman_yor.DISCOUNT, rng)
            drawn.update({(b, w): int(x) for (w, b), x in zip(pairs, t)})
            mine = sorted(there)
            c = [sum(drawn[b, w] for x, b in pairs if x == w) for w in mine]
            t = seat(np.array(c), np.full(len(c), base), pitman_yor.ROOT_DISCOUNT, rng)
            for w, x, y in zip(mine, c, t.tolist()):
                if x:
                    own_customers[n, w], own_tables[n, w] = x, y
        tables = drawn
    followers = Counter()
    for (before, _), c in counts.items():
        followers[before] += c

    def probability(before, word):
        mean = 0
        for t, of_context, root in kept:
            own = counts[before, word] - pitman_yor.DISCOUNT * t.get((before, word), 0)
            mean += own + (pitman_yor.STRENGTH + pitman_yor.DISCOUNT * of_context[before]) * root(word)
        return mean / len(kept) / (pitman_yor.STRENGTH + followers[before])

    return {key: sum(math.log10(probability(*p)) for p in s) for key, s in bigrams.items()}, probability, words


@pytest.mark.parametrize("dealt", [False, True])
def test_scores_equal_plain_seating(corpus, dealt, monkeypatch):
    """The same draws in dicts keyed by the words themselves, in one shard and in five with hot words."""
    layout = Layout(1, np.array([END], np.uint64))
    if dealt:
        many_shards(monkeypatch, pitman_yor)
        layout = pitman_yor.layout_for(None)
    else:
        monkeypatch.setattr(pitman_yor, "layout_for", lambda _: layout)
    rows = [(i, r["doc_id"], r["text"]) for i, r in enumerate(corpus.where("doc_id % 2 = 0 or doc_id is null").collect())]
    texts = [(i, t, k is not None and zlib.crc32(str(k).encode()) % 7 != 2) for i, k, t in rows]
    frame = corpus.sparkSession.createDataFrame(texts, "doc_id long, text string, learn boolean").repartition(2)
    expected, probability, words = plain_scores(texts, layout)
    for r in score_texts(frame, "learn").collect():
        assert r["score"] == pytest.approx(expected[r["doc_id"]], rel=1e-9)
    for before in [END, *sorted(words)[:3], 12345]:  # an unknown word takes one part of the base
        assert sum(probability(before, w) for w in words) + probability(before, 54321) == pytest.approx(1, abs=1e-9)


def test_contexts_have_restaurants_of_their_own():
    """However many contexts there are, and each owner has a range of them."""
    hashes = np.random.default_rng(3).integers(0, 1 << 64, 300_000, np.uint64)
    contexts = np.unique(shards.contexts_of(hashes))
    assert len(contexts) == len(np.unique(hashes))
    owners = pitman_yor.owners_of(contexts, 37)
    assert (np.diff(owners) >= 0).all() and set(owners.tolist()) == set(range(37))
    assert np.bincount(owners).max() < 1.1 * 300_000 / 37


def test_seating():
    rng = np.random.default_rng(1)
    customers = np.array([0, 1, 2, 5, 1000, 10**7])
    tables = seat(customers, np.full(6, 0.5), 0.8, rng)
    assert tables[0] == 0 and tables[1] == 1 and (tables <= customers).all() and (tables[1:] >= 1).all()
    # two customers: a second table with odds 0.5 to 1 - 0.8
    many = seat(np.full(20_000, 2), np.full(20_000, 0.5), 0.8, rng) - 1
    assert many.mean() == pytest.approx(0.5 / 0.7, abs=0.02)
    # customers one by one and in steps have the same mean
    one = np.mean([seat(np.full(300, 40), np.full(300, 3.0), 0.5, np.random.default_rng(s)).mean() for s in range(5)])
    assert 5 < one < 40


def test_scores_of_no_training_rows(spark):
    df = spark.createDataFrame([(1, "a b", False), (2, None, None)], "doc_id long, text string, train boolean")
    got = {r["doc_id"]: r for r in score_texts(df, "train").collect()}
    assert got[1]["n_known"] == 0 and got[1]["train_tokens"] == 0 and got[1]["n_tokens"] == 3
    assert got[1]["base_score"] == 0 and got[2]["n_tokens"] == 1


def test_no_rows(none):
    assert pitman_yor_query(none).count() == 0
    assert perplexities(none.withColumn("t", F.lit(True)), "t").count() == 0


def test_kneser_ney_sums_to_one():
    layout = Layout(1)
    words = np.sort(np.array([shards._hash(w) for w in (b"a", b"b", b"c", b"d")], np.uint64))
    blocks = [(words, np.array([4, 2, 1, 2], np.uint32), np.array([1, 1, 1, 2, 1, 2, 3, 1, 1]))]
    model = kneser_ney.Shard(blocks, 4, layout)
    sums = model.rest(0)
    totals = kneser_ney.Totals(
        model.of_contexts(), np.array([0, 0.6, 0.9, 1.2]), np.array([0, 0.5, 0.7, 0.9]),
        np.array([sums[-6], sums[-5], sums[-2]]), int(sums[-1]), 4, np.zeros(0, np.int64))
    for context in (0, 1, 2, 3):
        asked = np.append(words, np.uint64(12345))
        p = 10 ** model.log_probability(asked, np.full(5, context), totals)
        assert p.sum() == pytest.approx(1, abs=1e-9) and (p > 0).all()


def plain_perplexities(texts):
    """Interpolated modified Kneser-Ney in plain dicts, learned from ``(key, text, train)``."""
    pairs = {key: list(zip([None, *tokens(t)], tokens(t))) for key, t, _ in texts}
    counts = Counter(p for key, _, train in texts if train for p in pairs[key])
    follows, total, types = Counter(), Counter(), {}
    for (before, word), c in counts.items():
        follows[word] += 1
        total[before] += c
        types.setdefault(before, [0, 0, 0])[min(c, 3) - 1] += 1

    def discounted(values):
        n = [sum(v == k for v in values) for k in (1, 2, 3, 4)]
        d = discounts(*n).tolist()
        seen = [n[0], n[1], sum(v >= 3 for v in values)]
        return d, seen

    (d2, _), (d1, seen) = discounted(counts.values()), discounted(follows.values())

    def probability(before, word):
        spread = sum(d * k for d, k in zip(d1[1:], seen)) / len(counts)
        low = max(follows[word] - d1[min(follows[word], 3)], 0) / len(counts) + spread / (len(follows) + 1)
        if not total[before]:
            return low
        c = counts[before, word]
        backoff = sum(d * k for d, k in zip(d2[1:], types[before]))
        return (max(c - d2[min(c, 3)], 0) + backoff * low) / total[before]

    return {key: 10 ** -(sum(math.log10(probability(*p)) for p in ps) / len(ps)) for key, ps in pairs.items()}


@pytest.mark.parametrize("dealt", [False, True])
def test_perplexities_equal_plain_counts(corpus, dealt, monkeypatch):
    if dealt:
        many_shards(monkeypatch, kneser_ney)
    texts = [(i, r["text"], i % 3 == 0) for i, r in enumerate(corpus.collect())]
    frame = corpus.sparkSession.createDataFrame(texts, "doc_id long, text string, learn boolean").repartition(3)
    expected = plain_perplexities(texts)
    got = {r["doc_id"]: r["perplexity"] for r in perplexities(frame, "learn").collect()}
    assert got.keys() == expected.keys()
    for key, value in got.items():
        assert value == pytest.approx(expected[key], rel=1e-9)


def test_discounts():
    assert discounts(0, 1, 1, 1).tolist() == [0, 0.5, 0.5, 0.5]
    y = 100 / (100 + 80)
    assert discounts(100, 40, 20, 10) == pytest.approx([0, 1 - 2 * y * 0.4, 2 - 3 * y * 0.5, 3 - 4 * y * 0.5])


@pytest.mark.parametrize("dealt", [False, True])
def test_perplexity_tells_trusted_from_other_text(spark, corpus, dealt, monkeypatch):
    if dealt:
        many_shards(monkeypatch, kneser_ney)
    junk = spark.createDataFrame([(5000 + i, f"%%{i} $$ q{i}q zz{i * 7}" * 9) for i in range(20)], "doc_id long, text string")
    docs = corpus.unionByName(junk).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "en"))
    labels = docs.select("doc_id", F.when(F.col("doc_id") < 200, 1).otherwise(0).alias("quality"))
    rows = judge_quality(docs, labels).collect()
    assert len(rows) == docs.count()
    kept = {r["doc_id"]: r["kept"] for r in rows}
    assert sum(kept[i] for i in range(200)) >= 196 and not any(kept[5000 + i] for i in range(20))
    assert len({r["threshold"] for r in rows if r["lang"] == "en"}) == 1


def test_shards_do_not_change_perplexities(corpus, monkeypatch):
    marked = corpus.withColumn("t", F.col("doc_id") % 3 == 0)
    one = {r["doc_id"]: r["perplexity"] for r in perplexities(marked, "t").collect()}
    many_shards(monkeypatch, kneser_ney)
    other = {r["doc_id"]: r["perplexity"] for r in perplexities(marked, "t").collect()}
    assert one.keys() == other.keys() and all(one[k] == pytest.approx(other[k], rel=1e-9) for k in one)


def test_without_trusted_rows_all_are_kept(corpus):
    docs = corpus.withColumn("lang", F.lit("en"))
    labels = docs.select("doc_id", F.lit(0).alias("quality"))
    assert judge_quality(docs, labels).where("kept").count() == docs.count()


def test_the_limit_is_a_quantile_of_trusted_texts_not_learned_from(spark, corpus):
    docs = corpus.where("doc_id IS NOT NULL").withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "en"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    rows = [r for r in judge_quality(docs, labels).collect() if r["lang"] == "en"]
    limit = {r["threshold"] for r in rows}
    assert len(limit) == 1 and limit <= {r["perplexity"] for r in rows}  # one of the texts' own, not a multiple
    assert all(r["kept"] == (r["perplexity"] <= r["threshold"]) for r in rows)


@pytest.mark.parametrize("dealt", [False, True])
def test_every_trusted_text_is_learned_from(spark, dealt, monkeypatch):
    """More than 20,000 of them, each with a word of its own."""
    if dealt:
        many_shards(monkeypatch, kneser_ney)
    n = 30_000
    docs = spark.range(n).select(
        F.col("id").alias("doc_id"), F.format_string("w%d w%d", "id", "id").alias("text"), F.lit("en").alias("lang"))
    rows = judge_quality(docs, docs.select("doc_id", F.lit(1).alias("quality"))).select("perplexity").collect()
    # a text that was learned from has its words, a fifth of them haven't
    least = min(r["perplexity"] for r in rows)
    known = sum(r["perplexity"] < 2 * least for r in rows)
    assert len(rows) == n and 0.78 * n < known < 0.82 * n


def test_blocks_name_rare_contexts_by_their_hashes():
    rng = np.random.default_rng(5)
    words = np.unique(rng.integers(0, 1 << 64, 50, np.uint64))
    counts = rng.integers(1, 9, len(words)).astype(np.uint32)
    pool = np.unique(shards.contexts_of(rng.integers(0, 1 << 64, 40, np.uint64)))
    common = kneser_ney.Contexts(pool[::2], rng.permutation(len(pool[::2])).astype(np.uint32) + 1)
    contexts, docs = rng.choice(pool, counts.sum()), rng.integers(0, 99, counts.sum()).astype(np.uint16)
    w, c, number, others, d = kneser_ney.unpacked_pairs(kneser_ney.packed_pairs(words, counts, contexts, docs, common))
    back = np.append(np.uint64(0), common.by_number())[number]
    back[number == 0] = others
    assert (w == words).all() and (c == counts).all()
    of = np.repeat(np.arange(len(words)), counts)
    assert sorted(zip(of, back, d)) == sorted(zip(of, contexts, docs))
    known = pool[5:30]
    at = kneser_ney.Places(known, common).of_block(number, others)
    assert (np.append(np.uint64(0), known)[at] == np.where(np.isin(back, known), back, 0)).all()


def test_blocks_name_common_words_by_their_numbers():
    rng = np.random.default_rng(6)
    words = np.unique(rng.integers(0, 1 << 64, 3000, np.uint64))
    counts = rng.integers(1, 3, len(words)).astype(np.uint32)
    contexts = shards.contexts_of(rng.choice(words, counts.sum()))
    docs = rng.integers(0, 99, counts.sum()).astype(np.uint16)
    some = words[rng.random(len(words)) < 0.9]
    numbers = rng.permutation(len(some)).astype(np.uint32) + 1
    without = kneser_ney.Contexts(shards.contexts_of(some), numbers)
    common = kneser_ney.Contexts(shards.contexts_of(some), numbers, some)
    block = kneser_ney.packed_pairs(words, counts, contexts, docs, common)
    assert len(block) < 0.7 * len(kneser_ney.packed_pairs(words, counts, contexts, docs, without))
    w, c, number, others, d = kneser_ney.unpacked_pairs(block, common.words_by_number())
    back = np.append(np.uint64(0), common.by_number())[number]
    back[number == 0] = others
    assert sorted(zip(w, c)) == sorted(zip(words, counts))
    assert sorted(zip(np.repeat(w, c), back, d)) == sorted(zip(np.repeat(words, counts), contexts, docs))


def test_trusted_tokens_are_sent_once_to_be_scored_and_a_task_sends_a_chunk_one_block(corpus, monkeypatch):
    many_shards(monkeypatch, kneser_ney)
    monkeypatch.setattr(kneser_ney, "SHARDS", 2)
    monkeypatch.setattr(kneser_ney, "TASK_SHARDS", 5)
    sent, packs = [], []

    def watched(parts, columns):
        sent.extend(r["n"] for r in parts.where("block IS NOT NULL").groupBy("chunk").agg(F.count("*").alias("n")).collect())
        return shards.summed(parts, columns)

    def counted(docs, layout, pack):
        packs.append(docs.where("train").count())
        return shards.token_blocks(docs, layout, pack=pack)

    monkeypatch.setattr(kneser_ney, "summed", watched)
    monkeypatch.setattr(kneser_ney, "token_blocks", counted)
    marked = corpus.withColumn("t", F.col("doc_id") % 3 == 0)
    scored = perplexities(marked, "t")
    assert len(sent) > 1 and max(sent) <= 2  # five shards answer a chunk in two tasks
    # texts are cut into blocks once more, beside answers, scores and sums; trusted ones aren't sent besides
    assert len(packs) == 2 and scored._jdf.queryExecution().analyzed().toString().count("MapInArrow") == 4
    assert scored.count() == corpus.count()


def test_a_task_that_holds_many_sums_sends_them_before_its_end(corpus, monkeypatch):
    marked = corpus.withColumn("t", F.col("doc_id") % 3 == 0)
    one = {r["doc_id"]: r["perplexity"] for r in perplexities(marked, "t").collect()}
    many_shards(monkeypatch, kneser_ney)
    monkeypatch.setattr(kneser_ney, "HELD_SUMS", 0)
    other = {r["doc_id"]: r["perplexity"] for r in perplexities(marked, "t").collect()}
    assert one.keys() == other.keys() and all(one[k] == pytest.approx(other[k], rel=1e-9) for k in one)


def test_shards_grow_less_than_texts():
    assert [kneser_ney.shards_for(n) for n in (0, 1, 20_000_000, 840_000_000, 50_000_000_000)] == [0, 1, 5, 24, 391]
    assert [kneser_ney.scoring_tasks(Layout(n)) for n in (1, 24, 391)] == [24, 24, 49]
