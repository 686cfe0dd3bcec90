"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text.

Counts live in shards, dealt by word. A first pass over the trusted texts sums what belongs to no word:
the discounts, and how many words followed each context once, twice or more often. Each shard gives its
part of those to owners of ranges of contexts, who answer with the sums of what it asked for. A second pass
sends the tokens of every document to the shards, the trusted ones first, from which a shard counts its pairs
and words again before it scores them all; each document's log-probabilities are added up. Limits are quantiles of the perplexity of trusted texts
that the model hasn't learned from, one for each language.

A token's probability is its word's lower one times its context's weight, and more where the trusted texts
have the pair. A text's contexts are its words over again, so a shard charges each word's weight as a context
with the word itself, and needs of other contexts only those that its trusted pairs have.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressroom.llm import shards
from pressroom.llm.pitman_yor import owners_of
from pressroom.llm.shards import (
    COLUMNS, END, NOMINATING, SCHEMA, Layout, by_key, contexts_of, gaps, hash_of, packed, record, summed, token_blocks,
    unpacked,
)
from pressroom.session import write_and_read

#: Contexts that have numbers in blocks at most; others are named by their hashes, which take more bytes.
COMMON_CONTEXTS = 1 << 18
#: Trusted ids up to which they are broadcast to the documents; beyond, texts are shuffled to them.
SENT_IDS = 1 << 23
#: Characters of text for each shard, and so many shards at least where these have characters enough. Blocks of many
#: shards are small and compress less.
SHARD_CHARACTERS, SHARDS, SHARD_LEAST = 128_000_000, 24, 4_000_000
#: Shards that one task scores at most, if there are more than ``SHARDS`` of these. A task sends each document that it
#: has words of one sum, so few tasks shuffle little.
TASK_SHARDS = 8
#: Sums of documents that a scoring task holds, of 8 bytes each.
HELD_SUMS = 1 << 24
#: One trusted row in so many sets the limits and is not learned from.
CALIBRATION = 5
#: The limit is this quantile of the perplexity of trusted texts that were not learned from.
QUANTILE = 0.99


@dataclass
class Contexts:
    """Words before that are common, by their sorted hashes, and their numbers from 1. 0 is any other.

    Frequent ones have low numbers, which take few bytes between tasks.
    """

    hashes: np.ndarray
    numbers: np.ndarray
    words: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))  # whose contexts they are, if these have numbers too

    def of(self, hashes: np.ndarray) -> np.ndarray:
        return np.where(found(self.hashes, hashes), self.numbers[place(self.hashes, hashes)], np.uint32(0)) \
            if len(self.hashes) else np.zeros(len(hashes), np.uint32)

    def of_words(self, words: np.ndarray) -> np.ndarray:
        return np.where(found(self.words, words), self.numbers[place(self.words, words)], np.uint32(0)) \
            if len(self.words) else np.zeros(len(words), np.uint32)

    def by_number(self) -> np.ndarray:
        """Hashes of the numbers from 1."""
        return self.hashes[np.argsort(self.numbers)]

    def words_by_number(self) -> np.ndarray:
        return self.words[np.argsort(self.numbers)] if len(self.words) else self.words


def place(known: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Where each asked value would stand among the sorted known ones, which are some."""
    return np.minimum(np.searchsorted(known, asked), len(known) - 1)


def found(known: np.ndarray, asked: np.ndarray) -> np.ndarray:
    return known[place(known, asked)] == asked


def shards_for(characters: int) -> int:
    return max(-(-characters // SHARD_CHARACTERS), min(SHARDS, -(-characters // SHARD_LEAST)))


def layout_for(docs: DataFrame) -> Layout:
    return shards.layout_for(docs, shards_for=shards_for)


def scoring_tasks(layout: Layout) -> int:
    return max(SHARDS, -(-layout.shards // TASK_SHARDS))


def common_contexts(docs: DataFrame, text: str = "text") -> Contexts:
    """Words that are frequent in some documents: how contexts are written down, which changes no result."""
    some = docs.where(F.pmod(F.xxhash64(text), F.lit(NOMINATING)) == 0)
    words = some.select(F.explode(F.split(F.lower(text), r"[\x20\x09-\x0D]+")).alias("word")).where("word <> ''")
    most = words.groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(COMMON_CONTEXTS - 1)
    hashes = [END, *(hash_of(w.encode()) for w in most.select("word").toArrow()["word"].to_pylist())]
    known, first = np.unique(contexts_of(np.array(hashes, np.uint64)), return_index=True)
    return Contexts(known, (np.argsort(np.argsort(first)) + 1).astype(np.uint32), np.array(hashes, np.uint64)[first])


def named(hashes: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order of distinct hashes, and their gaps in it: of the hashes without a number (0), then of the numbers."""
    order = np.lexsort((hashes, numbers))
    rest = np.count_nonzero(numbers == 0)
    return order, gaps(hashes[order[:rest]]), gaps(numbers[order[rest:]])


def of_names(rest: np.ndarray, numbers: np.ndarray, by_number: np.ndarray) -> np.ndarray:
    """The hashes in the order of ``named``."""
    hashes = np.cumsum(rest, dtype=np.uint64)
    return np.concatenate([hashes, by_number[np.cumsum(numbers, dtype=np.int64) - 1]]) if len(numbers) else hashes


def packed_pairs(words: np.ndarray, counts: np.ndarray, contexts: np.ndarray, docs: np.ndarray, common: Contexts) -> bytes:
    """A block: distinct words, their tokens' number, and each token's context and document.

    Words are by their hashes, then those with numbers by them. A word's tokens are in the order of their
    contexts' numbers, so that those are given by their gaps.
    """
    number = common.of(contexts)
    by_name, *names = named(words, common.of_words(words))
    rank = np.empty(len(words), np.uint64)
    rank[by_name] = np.arange(len(words), dtype=np.uint64)
    order = np.argsort(np.repeat(rank, counts) << np.uint64(32) | number, kind="stable")
    number, counts = number[order], counts[by_name]
    gap, first = np.diff(number, prepend=np.uint32(0)), np.cumsum(counts, dtype=np.int64) - counts
    gap[first] = number[first]
    return packed(*names, counts, gap, contexts[order][number == 0], docs[order])


def unpacked_pairs(data: bytes, words: np.ndarray = np.zeros(0, np.uint64)) -> tuple[np.ndarray, ...]:
    """Words, counts, numbers of contexts, the hashes of those without (0), and documents of a block.

    ``words`` are the common ones by number.
    """
    rest, numbers, counts, gap, others, docs = unpacked(data, "u8", "u4", "u4", "u4", "u8", "u2")
    upto, first = np.cumsum(gap, dtype=np.int64), np.cumsum(counts, dtype=np.int64) - counts
    number = upto - np.repeat(upto[first] - gap[first], counts)
    return of_names(rest, numbers, words), counts, number, others, docs


class Places:
    """Places of a block's contexts among sorted hashes, from 1; 0 for those that aren't there."""

    def __init__(self, known: np.ndarray, common: Contexts):
        self.known = known
        self.of_number = np.append(0, self.of(common.by_number()))

    def of(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.zeros(len(hashes), np.int64)
        return np.where(found(self.known, hashes), place(self.known, hashes) + 1, 0)

    def of_block(self, number: np.ndarray, others: np.ndarray) -> np.ndarray:
        out = self.of_number[number]
        out[number == 0] = self.of(others)
        return out


def discounts(ones: int, twos: int, threes: int, fours: int) -> np.ndarray:
    """Discounts of counts 0, 1, 2 and 3 or more, by the closed estimate; 0.5 for each where it has no value."""
    if not (ones and twos and threes and fours):
        return np.array([0.0, 0.5, 0.5, 0.5])
    y = ones / (ones + 2 * twos)
    raw = np.array([0, 1 - 2 * y * twos / ones, 2 - 3 * y * threes / twos, 3 - 4 * y * fours / threes])
    return np.clip(raw, [0, 0.05, 0.05, 0.05], [0, 0.95, 1.9, 2.8])


@dataclass
class Totals:
    """By context its tokens and types seen 1, 2, 3+ times; the rest of the model, which all shards share."""

    contexts: np.ndarray    # by place in a shard's; all zero for 0
    pair_discounts: np.ndarray
    word_discounts: np.ndarray
    word_types: np.ndarray  # words that follow 1, 2, 3+ contexts
    pairs: int
    words: int
    hot: np.ndarray         # contexts that hot words follow


class Shard:
    """Trusted counts of a shard: its words, and pairs of word and context (one of ``width``) with their counts.

    A block has distinct words, their tokens' number and each token's context.
    """

    def __init__(self, blocks: list[tuple[np.ndarray, ...]], width: int, layout: Layout):
        self.width = max(width, 1)
        self.words = np.unique(np.concatenate([b[0] for b in blocks])) if blocks else np.zeros(0, np.uint64)
        keys = [np.repeat(np.searchsorted(self.words, w), n) * self.width + c for w, n, c in blocks]
        self.pairs, self.counts = np.unique(
            np.concatenate(keys) if keys else np.zeros(0, np.int64), return_counts=True)
        self.follows = np.bincount(self.pairs // self.width, minlength=len(self.words))
        self.hot = layout.hot_index(self.words)

    def of_contexts(self) -> np.ndarray:
        """By context its tokens, and its words seen once, twice and more often."""
        context = self.pairs % self.width
        types = [self.counts == 1, self.counts == 2, self.counts >= 3]
        return np.stack([
            np.bincount(context, self.counts, self.width).astype(np.int64),
            *(np.bincount(context[some], minlength=self.width) for some in types)])

    def rest(self, hot: int) -> np.ndarray:
        """Contexts that hot words follow, counts of counts of pairs and of other words, and pairs."""
        out = np.zeros(hot + 10, np.int64)
        np.add.at(out, self.hot[self.hot >= 0], self.follows[self.hot >= 0])
        cold = self.follows[self.hot < 0]
        out[-10:-6] = [(self.counts == k).sum() for k in (1, 2, 3, 4)]
        out[-6:-2] = [(cold == k).sum() for k in (1, 2, 3, 4)]
        out[-2:] = (cold >= 3).sum(), len(self.pairs)
        return out

    def log_probability(
        self, words: np.ndarray, contexts: np.ndarray, totals: Totals, charged: np.ndarray | None = None,
    ) -> np.ndarray:
        """log10 of each word's probability after its context.

        With ``charged`` it bears the weight of that context instead of its own, which counts for the pair
        alone, and may be 0 where the trusted texts don't have the pair.
        """
        if len(self.words):
            at = place(self.words, words)
            known = self.words[at] == words
            follows = np.where(self.hot >= 0, totals.hot[self.hot] if len(totals.hot) else 0, self.follows)
            n = np.where(known, follows[at], 0)
            keys = at * self.width + contexts
            pair = place(self.pairs, keys)
            c = np.where(known & (self.pairs[pair] == keys), self.counts[pair], 0)
        else:
            n = c = np.zeros(len(words), np.int64)
        all_pairs = max(totals.pairs, 1)
        spread = (totals.word_discounts[1:] * totals.word_types).sum() / all_pairs if totals.pairs else 1.0
        lower = (np.maximum(n - totals.word_discounts[np.minimum(n, 3)], 0) / all_pairs
                 + spread / (totals.words + 1))
        total, *types = totals.contexts
        backoff = sum(d * t for d, t in zip(totals.pair_discounts[1:], types))
        weight = np.log10(np.where(total > 0, backoff / np.maximum(total, 1), 1))
        out = np.log10(lower) + weight[contexts if charged is None else charged]
        seen = np.flatnonzero(c)
        own = c[seen] - totals.pair_discounts[np.minimum(c[seen], 3)]
        out[seen] += np.log10(1 + np.maximum(own, 0) / (backoff[contexts[seen]] * lower[seen]))
        return out


def _contexts_in(read: list[tuple[np.ndarray, ...]], of_hot: np.ndarray, by_number: np.ndarray) -> np.ndarray:
    """What a shard asks for: the contexts of its trusted pairs, its own words as contexts, and those of hot words."""
    return np.unique(np.concatenate([
        of_hot, *(x for w, _, n, others, _ in read for x in (
            contexts_of(w), others, by_number[np.unique(n[n > 0]) - 1]))]))


_ASKED = "owner int, shard int, block binary, slot long, n long"


def _asked(blocks: DataFrame, layout: Layout, common: Broadcast) -> DataFrame:
    """What the shards have of contexts, for their owners, and of everything else by slot, from trusted blocks."""
    hot = len(layout.hot)
    of_hot = contexts_of(layout.hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_number, common_words = common.value.by_number(), common.value.words_by_number()
        for rows, _ in by_key(batches, "shard"):
            read = [unpacked_pairs(r["block"], common_words) for r in rows]
            known = _contexts_in(read, of_hot, by_number)
            numbers = common.value.of(known)
            places = Places(known, common.value)
            shard = Shard([(w, c, places.of_block(n, others)) for w, c, n, others, _ in read], len(known) + 1, layout)
            sums = shard.of_contexts()[:, 1:]
            owner = owners_of(known, layout.shards)
            cuts = [0, *(np.flatnonzero(np.diff(owner)) + 1).tolist(), len(known)]
            made = []
            for a, b in zip(cuts, cuts[1:]):
                order, *names = named(known[a:b], numbers[a:b])
                made.append((int(owner[a]), packed(*names, *(x[a:b][order].astype(np.uint32) for x in sums))))
            rest = np.concatenate([sums[:, places.of(of_hot) - 1].reshape(-1), shard.rest(hot)])
            n, number = len(made), rows[0]["shard"]
            yield pa.RecordBatch.from_arrays(
                [pa.array([o for o, _ in made], pa.int32()), pa.array([number] * n, pa.int32()),
                 pa.array([x for _, x in made], pa.binary()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())], names=columns)
            n = len(rest)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(n, pa.int32()), pa.array([number] * n, pa.int32()), pa.nulls(n, pa.binary()),
                 pa.array(np.arange(n)), pa.array(rest)], names=columns)

    columns = ["owner", "shard", "block", "slot", "n"]
    return blocks.select("shard", "block").repartition("shard").sortWithinPartitions("shard").mapInArrow(run, _ASKED)


def _totals(asked: DataFrame, layout: Layout) -> Totals:
    """The sums that all shards share; ``contexts`` are those of hot words."""
    hot = len(layout.hot)
    sums = asked.where("owner IS NULL").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    dense = np.zeros(5 * hot + 10, np.int64)
    dense[sums["slot"].to_numpy()] = sums["n"].to_numpy()
    follows = dense[4 * hot:5 * hot]
    of_words = dense[-6:-2] + np.array([(follows == k).sum() for k in (1, 2, 3, 4)])
    many = int(dense[-2] + (follows >= 3).sum())
    types = np.array([of_words[0], of_words[1], many])
    return Totals(
        dense[:4 * hot].reshape(4, hot), discounts(*dense[-10:-6].tolist()), discounts(*of_words.tolist()),
        types, int(dense[-1]), int(types.sum()), follows)


def _answers(asked: DataFrame, layout: Layout, common: Broadcast) -> DataFrame:
    """``shard, chunk, block``: of each context that a shard asked for, its sums over all shards.

    A shard's are in the order of the contexts' hashes by ``chunk``, which is negative, and in each block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_number = common.value.by_number()
        for rows, _ in by_key(batches, "owner"):
            read = [unpacked(r["block"], "u8", *["u4"] * 5) for r in rows]
            hashes = [of_names(*x[:2], by_number) for x in read]
            known, at = np.unique(np.concatenate(hashes), return_inverse=True)
            sums = [np.bincount(at, np.concatenate([x[k] for x in read]), len(known)).astype(np.int64) for k in range(2, 6)]
            ends = np.cumsum([len(x) for x in hashes]).tolist()
            for row, a, b in zip(rows, [0, *ends], ends):
                own = np.sort(at[a:b])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["shard"]], pa.int32()), pa.array([row["owner"] - layout.shards], pa.int64()),
                     pa.array([packed(*(x[own] for x in sums))], pa.binary())], names=["shard", "chunk", "block"])

    return (asked.where("owner IS NOT NULL").select("owner", "shard", "block").repartition("owner")
            .sortWithinPartitions("owner").mapInArrow(run, "shard int, chunk long, block binary"))


def perplexities(
    docs: DataFrame, train: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``id, train, n_tokens, perplexity`` of every row, under a model of the rows where ``train`` is true.

    A null or empty text is its end alone; texts of any length are scored whole; repeated rows alike, null
    ids kept. With no trusted row every token has probability one. Every shard holds its part of the trusted
    rows' pairs, and the sums of the contexts in them.
    """
    source = docs.select(
        F.col(id_column).alias("id"), F.col(text_column).alias("text"),
        F.coalesce(F.col(train), F.lit(False)).alias("train"))
    layout = layout_for(source)
    context = docs.sparkSession.sparkContext
    common = context.broadcast(common_contexts(source))

    def for_counts(words, counts, contexts, docs) -> bytes:
        return packed_pairs(words, counts, contexts, np.zeros_like(docs), common.value)

    trusted = token_blocks(source.where("train"), layout, pack=for_counts).where("block IS NOT NULL")
    asked = write_and_read(_asked(trusted, layout, common), "asked-contexts")
    shared = context.broadcast(_totals(asked, layout))
    of_hot = contexts_of(layout.hot)

    def model_of(answers: list[bytes], blocks: list[bytes]) -> tuple[Shard, Places, Totals]:
        totals = shared.value
        read = [unpacked_pairs(b, common.value.words_by_number()) for b in blocks]
        if answers:
            known = _contexts_in(read, of_hot, common.value.by_number())
            sums = np.concatenate([np.stack(unpacked(a, *["i8"] * 4)) for a in answers], axis=1)
            if sums.shape[1] != len(known):
                raise ValueError("the trusted texts have changed since their first pass")
        else:
            known, first = np.unique(of_hot, return_index=True)
            sums = totals.contexts[:, first]
        places = Places(known, common.value)
        counted = [(w, c, places.of_block(n, others)) for w, c, n, others, _ in read]
        own = replace(totals, contexts=np.concatenate([np.zeros((4, 1), np.int64), sums], axis=1))
        return Shard(counted, len(known) + 1, layout), places, own

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A shard's answers come first, then its trusted blocks, which are scored when its model is made of them."""
        common_words = common.value.words_by_number()
        number, answers, trusted, model, schema = None, [], [], None, None
        sums: dict[int, np.ndarray] = {}  # by chunk, of its documents

        def add(row: dict) -> None:
            shard, places, totals = model
            words, counts, numbers, others, docs = unpacked_pairs(row["block"], common_words)
            score = np.bincount(docs, shard.log_probability(
                np.repeat(words, counts), places.of_block(numbers, others), totals,
                np.repeat(places.of(contexts_of(words)), counts)))
            held = sums.get(row["chunk"], score[:0])
            if len(held) < len(score):
                held = np.pad(held, (0, len(score) - len(held)))
            held[:len(score)] += score
            sums[row["chunk"]] = held

        def settle() -> None:
            nonlocal model, answers, trusted
            if model is None and (answers or trusted):
                model = model_of(answers, [r["block"] for r in trusted])
                for row in trusted:
                    add(row)
            answers, trusted = [], []

        def sent() -> Iterator[pa.RecordBatch]:
            for chunk, held in sums.items():
                some = np.flatnonzero(held)
                row = dict.fromkeys(COLUMNS) | {"chunk": chunk, "block": packed(some.astype(np.uint16), held[some])}
                yield record([row], COLUMNS, schema)
            sums.clear()

        for batch in batches:
            out, schema = [], batch.schema
            for row in batch.to_pylist():
                if row["shard"] != number:
                    settle()
                    number, model = row["shard"], None
                if row["block"] is None:
                    out.append(row)
                elif row["chunk"] < 0:
                    answers.append(row["block"])
                elif row["train"]:
                    trusted.append(row)
                else:
                    settle()
                    model = model or model_of([], [])
                    add(row)
            if out:
                yield record(out, COLUMNS, schema)
            if sum(map(len, sums.values())) > HELD_SUMS:
                yield from sent()
        settle()
        yield from sent()

    def for_scores(words, counts, contexts, docs) -> bytes:
        return packed_pairs(words, counts, contexts, docs, common.value)

    blocks = token_blocks(source, layout, pack=for_scores)
    dealt = blocks.unionByName(_answers(asked, layout, common), allowMissingColumns=True).select(*COLUMNS)
    first = F.when(F.col("chunk") < 0, 0).when(F.col("train"), 1).otherwise(2)
    kind = docs.schema[id_column].dataType.simpleString()
    parts = (dealt.repartition(F.col("shard") % scoring_tasks(layout)).sortWithinPartitions("shard", first, "chunk")
             .mapInArrow(run, SCHEMA.format(id=kind)))
    return summed(parts, ("score",)).select(
        F.col("id").alias(id_column), "train", "n_tokens",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))


def judge_quality(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    lang_column: str = "lang", label_column: str = "quality",
) -> DataFrame:
    """``id, lang, n_tokens, perplexity, threshold, kept``: one row per row of ``docs``.

    Trusted texts are labelled 1, and all of them are used. A
    language without a trusted text for its limit, null among them, gets the limit of all; without any
    trusted text there is no limit, and all are kept. Several labels of an id: trusted if one says so.
    """
    key = F.col(id_column)
    trusted = (
        labels.where(key.isNotNull() & (F.col(label_column) == 1)).select(key.alias("_id")).distinct()
        .withColumn("_use", F.when(F.pmod(F.xxhash64("_id", F.lit(1)), F.lit(CALIBRATION)) == 0, "limit").otherwise("learn")))
    source = docs.select(key.alias("_key"), F.col(text_column).alias("_text"), F.col(lang_column).alias("_lang"))
    few = trusted.count() <= SENT_IDS
    used = source.join(F.broadcast(trusted) if few else trusted, F.col("_key") == F.col("_id"), "left").select(
        F.struct(F.col("_key").alias("id"), F.col("_lang").alias("lang"), F.col("_use").alias("use")).alias("who"),
        "_text", (F.col("_use") == "learn").alias("_train"))
    scored = perplexities(used, "_train", "who", "_text")
    scored = write_and_read(scored.select("who.*", "n_tokens", "perplexity"), "perplexity")
    shown = scored.where("use = 'limit'")
    limit = F.percentile_approx("perplexity", QUANTILE, 10_000)
    overall = F.lit(shown.agg(limit.alias("overall")).first()["overall"]).cast("double")
    by_lang = shown.where("lang IS NOT NULL").groupBy(F.col("lang").alias("_lang")).agg(limit.alias("limit"))
    judged = scored.join(by_lang, F.col("lang") == F.col("_lang"), "left")
    threshold = F.coalesce("limit", overall)
    return judged.select(
        F.col("id").alias(id_column), F.col("lang").alias(lang_column), "n_tokens", "perplexity",
        threshold.alias("threshold"), F.coalesce(F.col("perplexity") <= threshold, F.lit(True)).alias("kept"))


def kneser_ney_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return judge_quality(docs, labels)
