import re

import pytest
from llm_helpers import odd_texts, text, union_find

import __spark_entry__
import corpus_pipeline
from pressroom.llm import registry

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Clean, toxic and junk texts, exact and near copies, and odd rows."""
    rows, labels = [], []
    for i in range(300):
        words = text(i, 120).split()
        if i % 6 == 0:
            words[7] = words[50] = ["foul", "vile", "rotten"][i % 3]
        rows.append((i, " ".join(words), "en", "s", 0))
        labels.append((i, 1, int(i % 6 == 0)))
    rows += [(1000 + i, rows[1 + i][1], "en", "s", 0) for i in range(4)]
    rows += [(2000 + i, rows[1 + i][1] + " more", "en", "s", 0) for i in range(4)]
    rows += [(3000 + i, "### " * 80, "en", "s", 0) for i in range(3)]
    rows += [(4000 + i, t, None, None, None) for i, t in enumerate(odd_texts())]
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path), rows, labels


def test_stages_keep_what_they_should(spark, tables):
    path, rows, labels = tables
    toxic = {k for k, _, t in labels if t}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "quality_rules", "ngram_jaccard_join", "best_fit_packing"]
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = stages["toxicity"](spark, docs, path)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert not ids & toxic and ids >= {r[0] for r in rows} - toxic
    kept = stages["quality_rules"](spark, kept, path)
    assert kept.columns == docs.columns
    left = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert set(left) >= {i for i in range(300) if i not in toxic} and not any(3000 <= i < 3003 for i in left)
    assert all(len(WORD.findall(t)) >= 50 for t in left.values())
    kept = stages["ngram_jaccard_join"](spark, kept, path)
    assert kept.columns == docs.columns
    keys = sorted(left)
    sets = {k: {tuple(w[i:i + 5]) for w in [WORD.findall(left[k])] for i in range(len(w) - 4)} for k in keys}
    edges = [(a, b) for a in keys for b in keys if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    root = union_find(keys, edges)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(root.values()))
    packed = stages["best_fit_packing"](spark, kept, path).collect()
    assert {r["doc_id"] for r in packed} == set(root.values())
    whole = corpus_pipeline.run(spark, path).collect()
    key = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted([r[c] for c in key] for r in whole) == sorted([r[c] for c in key] for r in packed)


def test_no_documents(spark, tables, tmp_path):
    path, _, _ = tables
    spark.read.parquet(f"{path}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{path}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_every_operator_is_registered_once():
    numbers = sorted(int(m[1]) for n in registry.QUERIES if (m := re.match(r"op(\d+)_", n)))
    assert numbers == list(range(1, 14))
    assert [n for n in registry.QUERIES if not n.startswith("op")] == ["rules_ablation"]
    found = __spark_entry__.queries()
    assert set(registry.QUERIES) | {"pipeline"} <= set(found)
    assert set(registry.ORACLE_SQL) <= set(registry.QUERIES)
