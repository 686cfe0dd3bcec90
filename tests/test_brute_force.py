"""Random small inputs against plain Python, one Spark job per operator."""

import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from pressroom.functions.text import with_clean_text
from pressroom.functions.tokens import gap_tokenizer, term_counts
from pressroom.operators.combine import widen
from pressroom.operators.dedupe import append_unseen
from pressroom.operators.split import with_row_index
from pressroom.operators.vectors import tfidf_table
from pressroom.schemas import ARTICLE, ARTICLE_FIELDS, RSS_FIELDS, SEARCH_FIELDS
from pressroom.sources.store import scan_store


def strings(seed, alphabet, n, longest):
    rng = random.Random(seed)
    return ["".join(rng.choices(alphabet, k=rng.randint(0, longest))) for _ in range(n)]


def test_strip(spark):
    texts = strings(1, "<>ab\n", 3000, 9)
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {r["id"]: r["text"] for r in with_clean_text(df, "text").collect()}
    want = {}
    for i, text in enumerate(texts):
        left = re.sub(r"<[^>]*>", "", text)
        if "<" not in left:
            want[i] = left
    assert got == want


def test_term_counts(spark):
    texts = strings(2, "ab  c", 2000, 30)
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    tokens = gap_tokenizer().transform(df)
    rows = tokens.select("id", F.inline(term_counts(F.col("words")))).collect()
    got = {(r["id"], r["term"]): r["n"] for r in rows}
    assert len(got) == len(rows)
    assert got == {(i, w): n for i, t in enumerate(texts) for w, n in Counter(t.split()).items()}


def test_tfidf_with_a_third_of_the_texts_alike(spark):
    texts = strings(3, "abcde  ", 200, 40) + ["a b b c"] * 100
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    tokens = gap_tokenizer().transform(df)
    got = {(r["id"], r["term"]): r["value"] for r in tfidf_table(tokens, "id", "words").collect()}
    docs = [Counter(t.split()) for t in texts]
    df_ = Counter(w for d in docs for w in d)
    want = {}
    for i, d in enumerate(docs):
        weights = {w: n * (math.log((1 + len(docs)) / (1 + df_[w])) + 1) for w, n in d.items()}
        norm = math.sqrt(sum(v * v for v in weights.values()))
        want.update({(i, w): v / norm for w, v in weights.items()})
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_row_index(spark):
    rng = random.Random(4)
    ids = list({int(rng.lognormvariate(10, 4)) - 500 for _ in range(4000)})
    df = spark.createDataFrame([(i,) for i in ids], "id long").repartition(6)
    got = {r["id"]: r["row_index"] for r in with_row_index(df, "id").collect()}
    assert got == {v: i for i, v in enumerate(sorted(ids))}


def test_insert_if_absent(spark, tmp_path):
    """Against inserting one article at a time, with every article equal to itself on its own fields."""
    rng = random.Random(5)

    def article():
        shape = rng.choice([RSS_FIELDS, SEARCH_FIELDS[:2]])
        made = {f: rng.choice([None, "x", "y", "z" * 3]) for f in shape}
        return made if any(v is not None for v in made.values()) else article()

    store, path = [], str(tmp_path / "store")
    for _ in range(4):
        hot = article()
        batch = [article() for _ in range(15)] + [hot] * 8
        rows = [tuple(a.get(f) for f in ARTICLE_FIELDS) for a in batch]
        append_unseen(widen(spark.createDataFrame(rows, ARTICLE).repartition(3)), path)
        for a in batch:
            if not any(all(s.get(f) == v for f, v in a.items()) for s in store):
                store.append(a)
        got = sorted(repr(tuple(r)) for r in scan_store(spark, path).collect())
        assert got == sorted(repr(tuple(a.get(f) for f in ARTICLE_FIELDS)) for a in store)
