"""Quality rules as a bitmask ledger, in DataFrame functions alone.

``ledger`` measures every text once and stores the measurements with one bit per failed rule.
Policies are versioned masks over those bits: changing a policy, or asking what one of its rules
removes, never touches a text again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressroom.llm.common import SPACES, WORD, let
from pressroom.session import write_and_read

#: Characters counted as symbols.
SYMBOLS = "#*$%&|<>"
#: Words in the windows whose repetition is measured.
WINDOW = 3

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper",
)


@dataclass(frozen=True)
class Rule:
    """A named bit and the SQL condition over the measurements under which a text fails."""

    name: str
    fails: str


#: Bit i of ``failures`` belongs to rule i; new rules are appended, so that stored ledgers stay valid.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("many_symbols", "10 * n_symbols > n_words"),
    Rule("short_words", "word_chars < 3 * n_words"),
    Rule("long_words", "word_chars > 12 * n_words"),
    Rule("duplicate_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule("shouting", "100 * n_upper > 40 * word_chars"),
    Rule("very_long", "n_words > 100000"),
)

#: Versions of the policy: the rules that reject. Length alone rejects only under version 2.
POLICIES = {
    1: ("few_words", "repeated_words", "many_symbols", "short_words", "long_words",
        "duplicate_lines", "shouting"),
    2: tuple(rule.name for rule in RULES),
}
#: The rules that reject under every policy.
BASE = ("few_words", "repeated_words")


def mask(names: tuple[str, ...]) -> int:
    """The bits of the named rules."""
    bits = {rule.name: 1 << i for i, rule in enumerate(RULES)}
    return sum(bits[name] for name in names)


def _repeat_words(words: Column) -> Column:
    """Words that lie in a window found twice or more, the first one included.

    Windows are compared by their 64-bit hashes. Sorting the (hash, position) pairs brings equal
    windows together; of the positions found so, each covers the words up to the next, three at most.
    """
    windows = let(words, lambda w: F.transform(
        F.slice(w, 1, F.greatest(F.size(w) - (WINDOW - 1), F.lit(0))),
        lambda x, i: F.xxhash64(x, *(F.get(w, i + k) for k in range(1, WINDOW)))))

    def covered(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
        found = let(pairs, lambda s: F.transform(
            F.filter(s, lambda x, i: (x["h"] == F.get(s, i - 1)["h"])
                     | (x["h"] == F.get(s, i + 1)["h"])),
            lambda x: x["p"]))
        return F.aggregate(
            F.sort_array(found),
            F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("sum")),
            lambda acc, p: F.struct(
                p.alias("last"),
                (acc["sum"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("sum")),
            lambda acc: acc["sum"])

    return let(windows, lambda h: F.when(
        F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the struct column ``rule_measures``, one pass over each whole text.

    A null text counts as an empty one. Every other column is carried as it is; an existing column
    named ``rule_measures`` is replaced.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    no_space = F.translate(value, SPACES, "")
    stripped = F.btrim(value, F.lit(SPACES))
    words = F.when(F.length(stripped) == 0, F.array().cast("array<string>")).otherwise(
        F.split(stripped, r"[\x20\x09-\x0D]+"))
    lines = F.filter(F.split(value, "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACES))) > 0)
    upper = F.length(value) - F.length(F.regexp_replace(value, r"\p{Lu}+", ""))

    def of_words(w: Column) -> Column:
        return F.struct(F.size(w).alias("n"), _repeat_words(w).alias("repeated"))

    def of_lines(x: Column) -> Column:
        return F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("distinct"))

    counted = F.struct(let(words, of_words).alias("words"), let(lines, of_lines).alias("lines"))
    return docs.withColumn("rule_measures", let(counted, lambda c: F.struct(
        c["words"]["n"].cast("long").alias("n_words"),
        F.length(no_space).cast("long").alias("word_chars"),
        (F.length(value) - F.length(F.translate(value, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        c["lines"]["n"].cast("long").alias("n_lines"),
        (c["lines"]["n"] - c["lines"]["distinct"]).cast("long").alias("n_dup_lines"),
        c["words"]["repeated"].cast("long").alias("n_repeat_words"),
        upper.cast("long").alias("n_upper"))))


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``rule_measures`` and ``rule_failures``, a long with bit i set where rule i fails.

    Defined for every row: null and empty texts have no word and fail the rule on few words; texts
    of any length are measured whole; repeated rows are judged alike, each on its own; an empty
    table gives an empty ledger. Both column names are replaced where the input has them.
    """
    measured = measure(docs, text)
    fields = {name: F.col("rule_measures")[name] for name in MEASURES}
    bits = F.lit(0).cast("long")
    for i, rule in enumerate(RULES):
        failed = F.expr(_qualified(rule.fails, fields))
        bits = bits.bitwiseOR(F.when(failed, F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return measured.withColumn("rule_failures", bits)


def _qualified(condition: str, fields: dict[str, Column]) -> str:
    """The condition with each measurement taken from the struct, so that columns can't clash."""
    return " ".join(f"rule_measures.{part}" if part in fields else part for part in condition.split())


def passes(version: int = 1) -> Column:
    """Whether a row of a ledger passes the policy of that version."""
    return F.col("rule_failures").bitwiseAND(F.lit(mask(POLICIES[version]))) == 0


def apply_policy(judged: DataFrame, version: int = 1) -> DataFrame:
    """The rows of a ledger that pass, without the ledger's columns."""
    return judged.where(passes(version)).drop("rule_measures", "rule_failures")


def ablation(judged: DataFrame, version: int = 1) -> DataFrame:
    """One row per rule of a policy: texts it fails, and texts that it alone rejects.

    Texts are first counted by bitmask (at most 2 ** rules rows leave any task); the rules then read
    those counts, so dropping a rule is evaluated without a second look at the texts.
    """
    chosen = mask(POLICIES[version])
    by_bits = judged.groupBy(F.col("rule_failures").bitwiseAND(F.lit(chosen)).alias("bits")).agg(
        F.count("*").alias("n"))
    rules = F.array(*(
        F.struct(F.lit(rule.name).alias("rule"), F.lit(1 << i).cast("long").alias("bit"))
        for i, rule in enumerate(RULES) if chosen >> i & 1))
    each = by_bits.select("bits", "n", F.explode(rules).alias("r"))
    return each.groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0))
        .alias("failed"),
        F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("alone"))


def rules_query(docs: DataFrame) -> DataFrame:
    judged = ledger(docs.select("doc_id", "text"))
    m = F.col("rule_measures")
    return judged.select(
        "doc_id",
        *(m[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        (F.col("rule_failures").bitwiseAND(F.lit(mask(BASE))) != 0).alias("base_failed"),
        passes(1).alias("kept"),
        F.col("rule_failures").alias("failures"))


def ablation_query(docs: DataFrame) -> DataFrame:
    """What each rule of version 1 fails and what it alone rejects, from a written ledger without texts."""
    judged = ledger(docs.select("doc_id", "text")).drop("text")
    return ablation(write_and_read(judged, "ledger"), 1)


RULES_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT *, regexp_extract_all(text, '{WORD}') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines
  FROM d
), g AS (
  SELECT row, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g
  FROM (SELECT row, words, unnest(range(1, len(words) - 1)) AS i FROM w)
), twice AS (
  SELECT row, i FROM g QUALIFY count(*) OVER (PARTITION BY row, g) > 1
), covered AS (
  SELECT row, count(DISTINCT p) AS n FROM (SELECT row, unnest([i, i + 1, i + 2]) AS p FROM twice)
  GROUP BY row
), m AS (
  SELECT doc_id, len(words) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(n, 0) AS n_repeat_words,
    length(text) - length(regexp_replace(text, '\p{{Lu}}', '', 'g')) AS n_upper
  FROM w LEFT JOIN covered USING (row)
), f AS (
  SELECT *,
    CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN word_chars < 3 * n_words THEN 8 ELSE 0 END
    + CASE WHEN word_chars > 12 * n_words THEN 16 ELSE 0 END
    + CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 32 ELSE 0 END
    + CASE WHEN 100 * n_upper > 40 * word_chars THEN 64 ELSE 0 END
    + CASE WHEN n_words > 100000 THEN 128 ELSE 0 END AS failures
  FROM m
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
  failures & 3 <> 0 AS base_failed, failures & 127 = 0 AS kept, failures::BIGINT AS failures
FROM f
"""

ABLATION_SQL = f"""
WITH judged AS ({RULES_SQL}),
rules AS (SELECT unnest({[r.name for r in RULES if r.name in POLICIES[1]]}) AS rule,
  unnest({[1 << i for i, r in enumerate(RULES) if r.name in POLICIES[1]]}) AS bit)
SELECT rule, count(*) FILTER (failures & bit <> 0) AS failed, count(*) FILTER (failures & {mask(POLICIES[1])} = bit) AS alone
FROM rules, (SELECT failures, count(*) OVER () FROM judged WHERE failures & {mask(POLICIES[1])} <> 0) GROUP BY rule
"""
