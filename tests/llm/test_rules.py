import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from pressroom.llm.rules import POLICIES, RULES, ablation, apply_policy, ledger, mask, rules_query

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def expected(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def measured(df):
    return df.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()


def test_measures_of_odd_texts(odd):
    texts = {}
    for r in odd.collect():
        texts.setdefault(r["doc_id"], []).append(r["text"])
    for r in measured(rules_query(odd)):
        assert tuple(r)[1:6] in {expected(t) for t in texts[r["doc_id"]]}
        n, repeated = r["n_words"], r["n_repeat_words"]
        assert r["base_failed"] == (n < 50 or 100 * repeated > 50 * n)


@settings(deadline=None, max_examples=5)
@given(st.lists(st.text("ab# \n\t", max_size=60), min_size=1, max_size=60))
def test_measures_of_repetitive_texts(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in measured(rules_query(df)):
        assert tuple(r)[1:6] == expected(texts[r["doc_id"]])


def test_policies_and_ablation(odd):
    judged = ledger(odd).cache()
    rows = judged.collect()
    assert judged.columns == [*odd.columns, "rule_measures", "rule_failures"]
    for version, names in POLICIES.items():
        bits = mask(names)
        kept = apply_policy(judged, version)
        assert kept.columns == odd.columns
        assert kept.count() == sum(r["rule_failures"] & bits == 0 for r in rows)
        got = {r["rule"]: (r["failed"], r["alone"]) for r in ablation(judged, version).collect()}
        for i, rule in enumerate(RULES):
            if rule.name in names:
                own = [r["rule_failures"] & bits for r in rows]
                assert got[rule.name] == (sum(x >> i & 1 for x in own), sum(x == 1 << i for x in own))


def test_a_column_named_like_the_ledger_is_replaced(odd):
    from pyspark.sql import functions as F

    again = ledger(odd.withColumn("rule_failures", F.lit("z")).withColumn("n_words", F.lit("z")))
    assert dict(again.dtypes)["rule_failures"] == "bigint" and again.where("n_words <> 'z'").isEmpty()


def test_no_rows(none):
    assert ledger(none).count() == 0 and ablation(ledger(none)).count() == 0


def test_the_plan_is_native_and_moves_nothing(odd):
    plan = rules_query(odd)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Exchange", "Generate"))
