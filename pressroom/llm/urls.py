"""URL filter: host rules first, then naive Bayes over segmented host and path tokens.

Names in hosts are written without spaces. The most probable split under a unigram model of words
(Viterbi) tells ``cheappills`` from ``theatre``; a multinomial naive Bayes model then weighs the words
of host and path. Its examples are the pages themselves: a host with a word of a given list is an
example of what to block, any other host an example of what to allow.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressroom.session import write_and_read

#: (host, path, verdict); a rule fits its host and all subdomains, and paths that begin with its own.
RULES = (
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"),
)
#: Words that mark a host as one to block.
BLOCK_WORDS = (
    "ad", "ads", "adult", "bet", "bets", "betting", "casino", "cheap", "crack", "farm", "free", "gamble",
    "hack", "loan", "loans", "lottery", "malware", "phishing", "pill", "pills", "poker", "porn", "prize",
    "sex", "slots", "spam", "spy", "torrent", "track", "tracker", "viagra", "warez", "win", "xxx",
)
#: Occurrences that a word of the list counts in the unigram model besides those in the pages.
WORD_PRIOR = 1000
#: Longest word looked for in a name.
WORD_LENGTH = 24
#: Tokens are hashed to this many features, which bounds the model on driver and executors.
FEATURES = 1 << 18
#: Hot hosts are spread over this many tasks.
SALT = 16


def host_path(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path; both empty for null and for a text without ``://``."""
    rest = F.when(F.locate("://", url) > 0, F.substr(url, F.locate("://", url) + 3))
    rest = F.coalesce(rest, F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), upper, upper.lower())
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """Struct ``rule, verdict`` of the longest rule that fits; nulls where none does."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        chosen = F.when(fits, F.struct(
            F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def names_of(text: Column) -> Column:
    """Runs of letters a-z of a lower-cased text."""
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z]+"), F.lit(0))


def word_counts(html: Column, pages: DataFrame) -> DataFrame:
    """``word, n``: words of a-z in the pages' visible text."""
    text = F.lower(F.regexp_replace(F.coalesce(html, F.lit("")), r"<[^>]*>", " "))
    words = pages.select(F.explode(F.regexp_extract_all(text, F.lit(r"\p{L}+"), F.lit(0))).alias("word"))
    return (words.where(F.col("word").rlike(f"^[a-z]{{1,{WORD_LENGTH}}}$"))
            .groupBy("word").agg(F.count("*").alias("n")))


def segment(name: str, matches: list[tuple[int, int, int]], total: int) -> list[str]:
    """The most probable split of ``name`` into words.

    ``matches`` are (start, length, count) of the words found in it. Of equal splits the one with the
    longer last word wins. What no word covers is unknown: the longer, the less probable, tenfold a letter.
    """
    ending: list[list[tuple[int, float]]] = [[] for _ in range(len(name) + 1)]
    for start, length, count in matches:
        ending[start + length].append((start, np.log10(count / total)))
    best, back = [0.0] + [-np.inf] * len(name), [0] * (len(name) + 1)
    for end in range(1, len(name) + 1):
        for start in range(max(0, end - WORD_LENGTH), end):
            score = best[start] + 1 - np.log10(total) - (end - start)
            if score > best[end]:
                best[end], back[end] = score, start
        for start, score in sorted(ending[end]):
            if best[start] + score > best[end]:
                best[end], back[end] = best[start] + score, start
    out, end = [], len(name)
    while end:
        out.append(name[back[end]:end])
        end = back[end]
    return out[::-1]


def segmented(names: DataFrame, counts: DataFrame) -> DataFrame:
    """``name, words`` of the distinct names. Substrings look their counts up in a join, so neither the
    names nor the vocabulary is held in one place."""
    seeds = names.sparkSession.createDataFrame([(w, WORD_PRIOR) for w in BLOCK_WORDS], "word string, n long")
    counts = counts.unionByName(seeds).groupBy("word").agg(F.sum("n").alias("n"))
    total = int(counts.agg(F.coalesce(F.sum("n"), F.lit(1))).first()[0])
    starts = names.select("name", F.explode(F.sequence(F.lit(0), F.length("name") - 1)).alias("start"))
    parts = starts.select(
        "name", "start",
        F.explode(F.sequence(F.lit(1), F.least(F.lit(WORD_LENGTH), F.length("name") - F.col("start")))).alias("length"))
    parts = parts.withColumn("part", F.expr("substring(name, start + 1, length)"))
    found = (parts.join(counts, parts["part"] == counts["word"])
             .groupBy("name").agg(F.collect_list(F.struct("start", "length", "n")).alias("matches")))

    def split(name: pa.Array, matches: pa.Array) -> pa.Array:
        return pa.array(
            [segment(a, [(m["start"], m["length"], m["n"]) for m in b or ()], total)
             for a, b in zip(name.to_pylist(), matches.to_pylist())], pa.list_(pa.string()))

    return names.join(found, "name", "left").select(
        "name", F.arrow_udf(split, "array<string>")("name", "matches").alias("words"))


def url_tokens(parsed: DataFrame, counts: DataFrame) -> DataFrame:
    """``parsed`` (with ``_host`` and ``_path``) and ``_words`` of its host and ``_tokens`` of both.

    A token counts once per url, so that a long repetitive path doesn't outweigh all others."""
    hosts = parsed.select("_host").distinct()
    named = hosts.select("_host", F.explode(names_of(F.col("_host"))).alias("name"))
    words = segmented(named.select("name").distinct(), counts)
    by_host = write_and_read(
        named.join(words, "name").groupBy("_host")
        .agg(F.flatten(F.collect_list("words")).alias("_words")), "hosts")
    salts = by_host.select(
        F.col("_host").alias("_h"), "_words", F.explode(F.array(*map(F.lit, range(SALT)))).alias("_s"))
    salted = parsed.withColumn("_salt", F.pmod(F.xxhash64("_all"), F.lit(SALT)).cast("int"))
    joined = salted.join(
        salts, (F.col("_host") == F.col("_h")) & (F.col("_salt") == F.col("_s")), "left").drop("_h", "_s", "_salt")
    path = F.transform(F.array_compact(F.regexp_extract_all(
        F.lower("_path"), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))),
        lambda x: F.concat(F.lit("/"), F.regexp_replace(x, "[0-9]+", "0")))
    none = F.array().cast("array<string>")
    return joined.withColumn("_words", F.coalesce("_words", none)).withColumn(
        "_tokens", F.array_distinct(F.concat("_words", F.coalesce(path, none))))


def bayes(tokens: DataFrame) -> np.ndarray:
    """Weight of each hashed token for blocking: the log of its rates' ratio, both classes weighing alike.

    Smoothing is by the same rate in both classes, so that a token never seen weighs nothing.
    """
    block = F.arrays_overlap("_words", F.array(*map(F.lit, BLOCK_WORDS)))
    counted = (
        tokens.select(block.alias("block"), F.explode("_tokens").alias("token"))
        .groupBy(F.pmod(F.xxhash64("token"), F.lit(FEATURES)).cast("int").alias("feature"))
        .agg(F.sum(F.when(F.col("block"), 1).otherwise(0)).alias("block"),
             F.sum(F.when(F.col("block"), 0).otherwise(1)).alias("allow"))).toArrow()  # FEATURES rows at most
    n = np.zeros((FEATURES, 2))
    n[counted["feature"].to_numpy()] = np.column_stack([counted["block"].to_numpy(), counted["allow"].to_numpy()])
    totals = np.maximum(n.sum(axis=0), 1)
    rates = n / totals + 1 / totals.sum()
    return np.log(rates[:, 0] / rates[:, 1])


def filter_urls(pages: DataFrame, counts: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with the struct ``url_verdict``: ``host, path, rule, verdict, score, words``.

    ``counts`` is the unigram model, as ``word_counts`` makes it; leave wide columns such as the markup
    out of ``pages``, for all of them are shuffled once. The rule's verdict holds; else block if the
    score is above zero. A null url, or one without ``://``, has empty host and path, no rule and the
    score 0, and is allowed. Any length of url is judged whole; repeated rows alike; no page, no row.
    Other columns are carried; ``url_verdict`` is replaced.
    """
    pages = pages.drop("url_verdict")
    host, path = host_path(F.col(url))
    parsed = pages.select(
        F.struct(*pages.columns).alias("_all"), host.alias("_host"), path.alias("_path"))
    # both are read twice: the markup behind the counts for a total, the tokens for their weights
    tokens = write_and_read(url_tokens(parsed, write_and_read(counts, "url-words")), "url-tokens")
    weights = pages.sparkSession.sparkContext.broadcast(bayes(tokens))

    def score(features: pa.Array) -> pa.Array:
        lengths = features.value_lengths().to_numpy()
        sums, has = np.zeros(len(features)), lengths > 0
        if has.any():  # each row's own sum, whatever its neighbours are
            starts = (np.cumsum(lengths) - lengths)[has]
            sums[has] = np.add.reduceat(weights.value[features.flatten().to_numpy()], starts)
        return pa.array(sums)

    hashed = F.transform("_tokens", lambda t: F.pmod(F.xxhash64(t), F.lit(FEATURES)).cast("int"))
    scored = tokens.withColumn("_score", F.arrow_udf(score, "double")(hashed))
    rule = rule_of(F.col("_host"), F.col("_path"))
    verdict = F.struct(
        F.col("_host").alias("host"), F.col("_path").alias("path"), rule["rule"].alias("rule"),
        F.coalesce(rule["verdict"], F.when(F.col("_score") > 1e-9, "block").otherwise("allow")).alias("verdict"),
        F.col("_score").alias("score"), F.col("_words").alias("words"))
    return scored.select("_all.*", verdict.alias("url_verdict"))


def url_query(pages: DataFrame) -> DataFrame:
    judged = filter_urls(pages.select("page_id", "url"), word_counts(F.col("html"), pages))
    return judged.select("page_id", *(F.col("url_verdict")[c].alias(c) for c in ("host", "path", "rule", "verdict", "score")))
