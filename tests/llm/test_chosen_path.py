import random
import re
from collections import Counter

import pytest
from llm_helpers import text, union_find
from pyspark.sql import functions as F

from pressroom.llm import chosen_path
from pressroom.llm.chosen_path import drop_near_duplicates, near_duplicates, runs_for
from pressroom.llm.common import WORD


def shingles(value):
    words = re.findall(WORD, value or "")
    return {tuple(words[i:i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def expected(rows):
    sets = [shingles(t) for _, t in rows]
    links, edges = Counter(), []
    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if a and 5 * common >= 4 * (len(a) + len(sets[j]) - common):
                links[i] += 1
                links[j] += 1
                edges.append((i, j))
    return [links[i] for i in range(len(rows))], union_find(range(len(rows)), edges)


def near_copies(n, words, seed, changes):
    """Copies of one text with a few words changed, some exact."""
    rng = random.Random(seed)
    base = text(seed, words).split()
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randrange(changes + 1)):
            copy[rng.randrange(words)] = f"new{rng.randrange(10_000)}"
        out.append(" ".join(copy))
    return out


@pytest.fixture(scope="module")
def corpus():
    passage = text(99, 30)
    texts = near_copies(120, 200, 1, 6) + near_copies(40, 100, 2, 3) + near_copies(10, 7, 3, 1)
    texts += [f"{passage} {text(1000 + i, 60)}" for i in range(60)]
    texts += [text(2000 + i, 80) for i in range(60)] + [None, "", "  ", "a", "a", "a b c d", "a b c d", "A b c d"]
    random.Random(5).shuffle(texts)
    return [(i * 7 + 3, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("bucket", [256, 20])
def test_links_and_classes_are_those_of_brute_force(spark, corpus, bucket, monkeypatch):
    monkeypatch.setattr(chosen_path, "BUCKET", bucket)
    df = spark.createDataFrame(corpus, "doc_id long, text string").repartition(4)
    links, root = expected(corpus)
    first = {}
    for i, (key, _) in enumerate(corpus):
        first[root[i]] = min(first.get(root[i], key), key)
    got = {r["doc_id"]: (r["n_links"], r["class_id"]) for r in near_duplicates(df).collect()}
    assert got == {key: (links[i], first[root[i]]) for i, (key, _) in enumerate(corpus)}


def test_one_text_of_each_class_stays(spark, corpus):
    df = spark.createDataFrame(corpus, "doc_id long, text string").withColumn("node", F.lit("mine"))
    kept = drop_near_duplicates(df)
    _, root = expected(corpus)
    first = {}
    for i, (key, _) in enumerate(corpus):
        first[root[i]] = min(first.get(root[i], key), key)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(first.values())
    assert kept.columns == ["doc_id", "text", "node"]


def test_odd_rows(odd):
    rows = near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], []).append(r)
    assert [(r["n_links"], r["class_id"]) for r in by_id[5] + by_id[6]] == [(1, 5), (1, 5)]
    assert by_id[3][0]["n_links"] == 1 and by_id[None][0]["class_id"] == 3
    assert all(r["n_links"] == 0 for k in (0, 1, 2) for r in by_id[k])
    ids = [r["doc_id"] for r in drop_near_duplicates(odd).collect()]
    assert len(ids) == len(set(ids)) and set(ids) == set(by_id) - {6}


def test_no_rows(none):
    assert near_duplicates(none).count() == 0 and drop_near_duplicates(none).count() == 0


def test_runs_grow_with_the_recall():
    assert runs_for(0.9) < runs_for(0.999) < runs_for(0.999999)
