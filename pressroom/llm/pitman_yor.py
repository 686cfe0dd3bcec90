"""Scores of texts under a hierarchical Pitman-Yor language model.

Every context, the word before, has a restaurant whose customers are the words that followed it; all of
them share the root restaurant as parent, whose customers are their tables. Seating is sampled by Gibbs
sweeps: given the parent's probabilities and the tables of each restaurant, every dish's customers are
seated anew, one by one, and the root's after them. Sweeps after the first few are kept, and a word's
probability is the mean of what they predict.

Everything about a word lies in its shard, so a restaurant's tables stand in many shards. A shard also
owns the restaurants of a range of contexts: after a sweep the shards send the owners their tables of
each restaurant, and the owners send back the sums, as one block for each pair of shards. A restaurant
where no dish has a second customer has as many tables as customers, whatever is drawn, and is told once.
What goes through the driver belongs to no restaurant: the root's totals and hot words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressroom.llm.common import fold, written_by
from pressroom.llm.shards import (
    COLUMNS, CONTEXT_BITS, SCHEMA, Layout, by_key, gaps, layout_for, packed, record, summed, token_blocks,
    unpacked, unpacked_tokens,
)

#: Discount and strength of the context restaurants and of the root.
DISCOUNT, STRENGTH = 0.8, 10.0
ROOT_DISCOUNT, ROOT_STRENGTH = 0.6, 100.0
#: Sweeps that are forgotten and sweeps that are averaged.
BURN_IN, SAMPLES = 2, 3
SWEEPS = BURN_IN + SAMPLES
#: Tasks of a sweep at most; a task then has several shards, one at a time.
TASKS = 20_000
#: Rows between shards, owners and the driver: state, tables asked about, sums of them, parts of the totals.
_MESSAGE = pa.schema([
    ("kind", pa.string()), ("shard", pa.int32()), ("chunk", pa.int64()), ("block", pa.binary()),
    ("slots", pa.list_(pa.int64())), ("amounts", pa.list_(pa.int64()))])
_MESSAGE_SCHEMA = "kind string, shard int, chunk long, block binary, slots array<long>, amounts array<long>"


def owners_of(contexts: np.ndarray, shards: int) -> np.ndarray:
    """The owning shard of each context; it ascends with the context."""
    return ((contexts >> np.uint64(CONTEXT_BITS - 32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int32)


def seat(customers: np.ndarray, weight: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of each dish after its customers were seated one by one.

    ``weight`` is what a new table weighs; the tables there weigh the customers seated less their
    discounts. From the 32nd customer on, a sixteenth of those seated come in at once under the same odds.
    """
    tables = (customers > 0).astype(np.int64)
    order = np.argsort(-customers, kind="stable")
    c, w = customers[order], weight[order]
    t = tables[order]
    seated = 1
    live = int(np.searchsorted(-c, -seated))  # dishes with more customers than are seated
    while live:
        step = 1 if seated < 32 else seated // 16
        coming = np.minimum(step, c[:live] - seated)
        odds = w[:live] / (w[:live] + seated - discount * t[:live])
        t[:live] += rng.binomial(coming, odds) if step > 1 else rng.random(live) < odds
        seated += step
        live = int(np.searchsorted(-c, -seated))
    tables[order] = t
    return tables


@dataclass
class Totals:
    """What all shards share after a sweep."""

    hot_customers: np.ndarray  # of the root, for hot words
    hot_tables: np.ndarray
    hot_counts: np.ndarray   # training tokens of hot words
    root_customers: int
    root_tables: int
    words: int               # distinct training words (V)
    tokens: int              # training tokens (N)


class Shard:
    """A shard's training counts, and what it was told of its contexts' restaurants.

    ``words`` are sorted hashes; ``pairs`` are places of word and context as one number, by which they
    ascend. ``customers`` and ``tables_of`` are the restaurants' over all shards; only those at the places
    ``live`` change their tables.
    """

    def __init__(
        self, number: int, words: np.ndarray, pairs: np.ndarray, counts: np.ndarray, customers: np.ndarray,
        tables_of: np.ndarray, live: np.ndarray, layout: Layout,
    ):
        self.number, self.words, self.pairs = number, words, pairs
        self.customers, self.tables_of, self.live = customers, tables_of, live
        self.width = max(len(customers), 1)
        self.counts = counts.astype(np.int64)
        self.word, self.context = (pairs // self.width).astype(np.int32), (pairs % self.width).astype(np.int32)
        self.hot = layout.hot_index(words)
        self.is_hot = self.hot >= 0
        self.word_counts = np.bincount(self.word, self.counts, len(words)).astype(np.int64)
        self.tables = np.ones(len(pairs), np.int64)
        self.root_customers = np.bincount(self.word, minlength=len(words))
        self.root_tables = (self.root_customers > 0).astype(np.int64)
        self.kept_tables = np.zeros(len(pairs), np.int64)  # the kept sweeps' together
        self.kept: list[tuple[np.ndarray, np.ndarray]] = []  # by kept sweep: the root, tables of the live

    def global_counts(self, totals: Totals) -> np.ndarray:
        return np.where(self.is_hot, totals.hot_counts[self.hot] if len(totals.hot_counts) else 0, self.word_counts)

    def root(self, totals: Totals) -> np.ndarray:
        """The root's probability of each word."""
        c, t = self.root_customers, self.root_tables
        if self.is_hot.any():
            c = np.where(self.is_hot, totals.hot_customers[self.hot], c)
            t = np.where(self.is_hot, totals.hot_tables[self.hot], t)
        return (c - ROOT_DISCOUNT * t + _root_weight(totals)) / (ROOT_STRENGTH + totals.root_customers)

    def sweep(self, number: int, totals: Totals) -> None:
        """Seat all customers anew, given the totals of the sweep before."""
        rng = np.random.default_rng((number, self.number))
        weight = (STRENGTH + DISCOUNT * self.tables_of[self.context]) * self.root(totals)[self.word]
        self.tables = seat(self.counts, weight, DISCOUNT, rng)
        self.root_customers = np.bincount(self.word, self.tables, len(self.words)).astype(np.int64)
        self.root_tables = seat(self.root_customers, np.full(len(self.words), _root_weight(totals)), ROOT_DISCOUNT, rng)
        if number >= BURN_IN:
            self.kept_tables += self.tables

    def told(self, tables: np.ndarray, sweeps: int, totals: Totals) -> None:
        """What so many sweeps have led to: the live restaurants' tables and the totals."""
        self.tables_of[self.live] = tables
        if sweeps > BURN_IN:
            self.kept.append((self.root(totals), self.tables_of[self.live]))

    def own_tables(self) -> np.ndarray:
        """The shard's tables in each live restaurant."""
        return np.bincount(self.context, self.tables, self.width).astype(np.uint64)[self.live]

    def shared(self, hot: int) -> tuple[np.ndarray, np.ndarray]:
        """The shard's part of the totals, as slots and values."""
        cold = ~self.is_hot
        dense = np.zeros(2 * hot + 4, np.int64)
        np.add.at(dense, self.hot[self.is_hot], self.root_customers[self.is_hot])
        np.add.at(dense, hot + self.hot[self.is_hot], self.word_counts[self.is_hot])
        dense[-4:] = (self.root_customers[cold].sum(), self.root_tables[cold].sum(),
                      (self.word_counts[cold] > 0).sum(), self.counts.sum())
        slots = np.flatnonzero(dense)
        return slots, dense[slots]

    def state(self) -> bytes:
        return packed(
            self.root_customers.astype(np.int64), self.root_tables.astype(np.int64), self.kept_tables,
            *(a for pair in self.kept for a in pair))

    def restore(self, state: bytes, sweeps: int) -> None:
        """The state after so many sweeps, before ``told`` of them."""
        kept = max(sweeps - BURN_IN - 1, 0)
        self.root_customers, self.root_tables, tables, *rest = unpacked(state, "i8", "i8", "i8", *["f8", "u8"] * kept)
        self.kept_tables = tables.copy()
        self.kept = list(zip(rest[::2], rest[1::2]))

    @cached_property
    def new_tables(self) -> list[np.ndarray]:
        """By kept sweep, what a new table weighs in each restaurant."""
        weights = []
        for _, live in self.kept:
            tables = self.tables_of.astype(np.float64)
            tables[self.live] = live
            weights.append(STRENGTH + DISCOUNT * tables)
        return weights

    def probability(self, at: np.ndarray, contexts: np.ndarray) -> np.ndarray:
        """Mean probability, over the kept sweeps, of words after contexts, both by their places."""
        keys = at.astype(np.int64) * self.width + contexts
        own = np.zeros(len(keys))
        if len(self.pairs):
            place = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
            mean = self.counts[place] - DISCOUNT * self.kept_tables[place] / len(self.kept)
            own = np.where(self.pairs[place] == keys, mean, 0.0)
        rest = sum(new[contexts] * root[at] for (root, _), new in zip(self.kept, self.new_tables))
        return (own + rest / len(self.kept)) / (STRENGTH + self.customers[contexts])

    def scores(self, at: np.ndarray, contexts: np.ndarray, totals: Totals) -> tuple[np.ndarray, ...]:
        """Base score, score and whether it is known, of each token."""
        counts = self.global_counts(totals)
        base = np.log10((counts + 1) / (totals.tokens + totals.words + 1))
        return base[at], np.log10(self.probability(at, contexts)), (counts > 0)[at]


def _root_weight(totals: Totals) -> float:
    return (ROOT_STRENGTH + ROOT_DISCOUNT * totals.root_tables) / (totals.words + 1)


def _totals(parts: DataFrame, layout: Layout, number: int, before: Totals | None) -> Totals:
    """Sums of the shards' parts; slots are bounded by the hot words."""
    pair = F.explode(F.arrays_zip("slots", "amounts")).alias("pair")
    found = (parts.where("kind = 'sum'").select(pair).groupBy(F.col("pair.slots").alias("slot"))
             .agg(F.sum("pair.amounts").alias("value")).toArrow())
    hot = len(layout.hot)
    dense = np.zeros(2 * hot + 4, np.int64)
    dense[found["slot"].to_numpy()] = found["value"].to_numpy()
    customers, counts = dense[:hot], dense[hot:2 * hot]
    if before is None:
        tables = (customers > 0).astype(np.int64)
    else:
        tables = seat(customers, np.full(hot, _root_weight(before)), ROOT_DISCOUNT, np.random.default_rng(number))
    return Totals(
        customers, tables, counts, int(dense[-4] + customers.sum()), int(dense[-3] + tables.sum()),
        int(dense[-2] + (counts > 0).sum()), int(dense[-1]))


def _messages(rows: list[dict]) -> pa.RecordBatch:
    none = dict.fromkeys(_MESSAGE.names)
    return record([none | r for r in rows], tuple(_MESSAGE.names), _MESSAGE)


def _counted(blocks: DataFrame, layout: Layout) -> DataFrame:
    """The rows of the blocks, with words and contexts by their places in the shard, and more of kind

    - counts, one for each shard: its words and the counts of its pairs;
    - keys, one for each shard and owner: contexts, their customers and pairs.
    """
    names = ("kind", *COLUMNS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = dict.fromkeys(names)
        for rows, schema in by_key(batches, "shard"):
            number = rows[0]["shard"]
            found = [unpacked_tokens(r["block"])[0:3:2] for r in rows if r["block"] is not None]
            words, contexts = (
                np.unique(np.concatenate([f[i] for f in found])) if found else np.zeros(0, np.uint64) for i in (0, 1))
            del found
            keys = []
            for row in rows:
                if row["block"] is not None:
                    own, n, known, place, docs = unpacked_tokens(row["block"])
                    at = np.searchsorted(words, own).astype(np.uint32)
                    context = np.searchsorted(contexts, known).astype(np.uint32)
                    if row["train"]:
                        keys.append(np.repeat(at.astype(np.int64), n) * len(contexts) + context[place])
                    row["block"] = packed(gaps(at), n, gaps(context), place, gaps(docs))
            pairs, counts = np.unique(np.concatenate(keys) if keys else np.zeros(0, np.int64), return_counts=True)
            del keys
            block = packed(gaps(words), gaps(pairs), counts.astype(np.uint32), np.array([len(contexts)], np.uint32))
            yield record([none | {"kind": "counts", "shard": number, "block": block}], names, schema)
            context = pairs % max(len(contexts), 1)
            customers = np.bincount(context, counts, len(contexts)).astype(np.uint64)
            dishes = np.bincount(context, minlength=len(contexts)).astype(np.uint64)
            owners, first = np.unique(owners_of(contexts, layout.shards), return_index=True)
            for owner, a, b in zip(owners.tolist(), first.tolist(), [*first[1:].tolist(), len(contexts)]):
                block = packed(gaps(contexts[a:b]), customers[a:b], dishes[a:b])
                yield record([none | {"kind": "keys", "shard": owner, "chunk": number, "block": block}], names, schema)
            for start in range(0, len(rows), 64):
                yield record([r | {"kind": "tokens"} for r in rows[start:start + 64]], names, schema)

    kind = blocks.schema["id"].dataType.simpleString()
    return (blocks.repartition("shard").sortWithinPartitions("shard")
            .mapInArrow(run, "kind string, " + SCHEMA.format(id=kind)))


def _known(keys: DataFrame) -> DataFrame:
    """What owners tell each shard: its contexts' customers and tables, which are live, and their numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _ in by_key(batches, "shard"):
            read = [unpacked(r["block"], "u8", "u8", "u8") for r in rows]
            read = [(np.cumsum(contexts, dtype=np.uint64), *rest) for contexts, *rest in read]
            contexts = np.unique(np.concatenate([r[0] for r in read]))
            customers, dishes = np.zeros((2, len(contexts)), np.uint64)
            for own, c, d in read:
                at = np.searchsorted(contexts, own)
                customers[at] += c
                dishes[at] += d
            live = customers != dishes
            number = (np.cumsum(live) - 1).astype(np.uint32)
            for row, (own, _, _) in zip(rows, read):
                at = np.searchsorted(contexts, own)
                mine = live[at]
                block = packed(customers[at], dishes[at], mine.astype(np.uint8), number[at][mine])
                yield _messages([{"kind": "known", "shard": row["chunk"], "chunk": row["shard"], "block": block}])

    return (keys.select("shard", "chunk", "block").repartition("shard").sortWithinPartitions("shard", "chunk")
            .mapInArrow(run, _MESSAGE_SCHEMA))


def _ready(counts: DataFrame, known: DataFrame, layout: Layout) -> DataFrame:
    """For each shard one block of all that stays the same, and its part of the first totals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (first, *told), _ in by_key(batches, "shard"):
            words, pairs, counts, width = unpacked(first["block"], "u8", "i8", "u4", "u4")
            read = [unpacked(r["block"], "u8", "u8", "u1", "u4") for r in told]
            customers, tables, live, numbers = (
                np.concatenate([r[i] for r in read]) if read else np.zeros(0, kind)
                for i, kind in enumerate((np.uint64, np.uint64, np.uint8, np.uint32)))
            assert len(customers) == int(width[0]), "an owner's answer is missing"
            owners = np.array([r["chunk"] for r in told], np.uint32)
            sizes = np.array([len(r[3]) for r in read], np.uint32)
            block = packed(
                words, pairs, counts, customers, tables, gaps(np.flatnonzero(live).astype(np.uint32)),
                owners[sizes > 0], sizes[sizes > 0], numbers)
            shard = _loaded(first["shard"], block, layout)[0]
            slots, amounts = shard.shared(len(layout.hot))
            yield _messages([
                {"kind": "ready", "shard": first["shard"], "block": block},
                {"kind": "sum", "slots": slots, "amounts": amounts}])

    rows = counts.select("kind", "shard", "chunk", "block").union(known.select("kind", "shard", "chunk", "block"))
    return (rows.repartition("shard").sortWithinPartitions("shard", "kind", "chunk")
            .mapInArrow(run, _MESSAGE_SCHEMA))


def _loaded(number: int, block: bytes, layout: Layout) -> tuple[Shard, np.ndarray, np.ndarray, np.ndarray]:
    """The shard; the owners of its live contexts, how many each has, and the numbers there."""
    words, pairs, counts, customers, tables, live, owners, sizes, numbers = unpacked(
        block, "u8", "i8", "u4", "u8", "u8", "u4", "u4", "u4", "u4")
    shard = Shard(
        number, np.cumsum(words, dtype=np.uint64), np.cumsum(pairs), counts, customers, tables.copy(),
        np.cumsum(live, dtype=np.uint32), layout)
    return shard, owners, sizes, numbers


def _joined(blocks: list[bytes]) -> np.ndarray:
    """Owners' answers, in their order, as one array."""
    return np.concatenate([np.zeros(0, np.uint64), *(unpacked(b, "u8")[0] for b in blocks)])


def _swept(ready: DataFrame, inbox: DataFrame | None, layout: Layout, sweep: int, totals: Totals) -> DataFrame:
    """One sweep of every shard: its state, its questions to owners and its part of the totals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                shard, owners, sizes, numbers = _loaded(row["shard"], row["block"], layout)
                if sweep:
                    *answers, state = row["inbox"]
                    shard.restore(state["block"], sweep)
                    shard.told(_joined([a["block"] for a in answers]), sweep, totals)
                shard.sweep(sweep, totals)
                slots, amounts = shard.shared(len(layout.hot))
                yield _messages([
                    {"kind": "state", "shard": shard.number, "block": shard.state()},
                    {"kind": "sum", "slots": slots, "amounts": amounts}])
                tables, at = shard.own_tables(), 0
                for owner, size in zip(owners.tolist(), sizes.tolist()):
                    block = packed(numbers[at:at + size], tables[at:at + size])
                    at += size
                    yield _messages([{"kind": "ask", "shard": owner, "chunk": shard.number, "block": block}])

    if inbox is None:
        given = ready.select("shard", "block", F.lit(None).alias("inbox"))
    else:  # answers by owner, then the state
        kept = F.sort_array(F.collect_list(F.struct("kind", "chunk", "block"))).alias("inbox")
        given = ready.join(inbox.groupBy("shard").agg(kept), "shard")
    return given.mapInArrow(run, _MESSAGE_SCHEMA)


def _answers(asked: DataFrame) -> DataFrame:
    """Owners' sums of the tables that shards asked about, to each of those shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _ in by_key(batches, "shard"):
            read = [unpacked(r["block"], "u4", "u8") for r in rows]
            sums = np.zeros(1 + max(int(numbers.max()) for numbers, _ in read), np.uint64)
            for numbers, tables in read:
                sums[numbers] += tables
            for row, (numbers, _) in zip(rows, read):
                yield _messages([{
                    "kind": "answer", "shard": row["chunk"], "chunk": row["shard"], "block": packed(sums[numbers])}])

    return (asked.select("shard", "chunk", "block").repartition("shard").sortWithinPartitions("shard", "chunk")
            .mapInArrow(run, _MESSAGE_SCHEMA))


def score_texts(
    docs: DataFrame, train: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``id, train, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    The model learns from rows where the boolean column ``train`` is true. Tokens are the words, A-Z
    lower-cased, and an end; a null or empty text is its end alone. ``base_score`` is the add-one
    unigram model's log10 probability, ``score`` this model's; unknown words share one part of
    ``V + 1`` of the root's base. Repeated rows are counted and scored as often as they come, null ids
    kept. Without training rows all words are unknown; without rows there are none.
    """
    source = docs.select(
        F.col(id_column).alias("id"), F.col(text_column).alias("text"),
        F.coalesce(F.col(train), F.lit(False)).alias("train"))
    layout = layout_for(source)
    table = written_by(_counted(token_blocks(source, layout), layout), "shards", "kind")
    known = _known(table.where("kind = 'keys'"))
    begun = written_by(_ready(table.where("kind = 'counts'"), known, layout), "ready", "kind")
    totals = _totals(begun, layout, 0, None)
    ready = begun.where("kind = 'ready'").select("shard", "block")
    held = ready.repartition(min(layout.shards, TASKS), "shard").persist(StorageLevel.DISK_ONLY)
    inbox = None
    for sweep in range(SWEEPS):
        swept = written_by(_swept(held, inbox, layout, sweep, totals), "swept", "kind")
        totals = _totals(swept, layout, sweep + 1, totals)
        states = swept.where("kind = 'state'")
        inbox = states.unionByName(_answers(swept.where("kind = 'ask'"))).select("kind", "shard", "chunk", "block")
    held.unpersist()
    last = totals

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A shard's block of counts comes first, then answers by owner, its state, and tokens."""
        shard, answers = None, []
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["kind"] == "a block":
                    shard, answers = _loaded(row["shard"], row["block"], layout)[0], []
                elif row["kind"] == "answer":
                    answers.append(row["block"])
                elif row["kind"] == "state":
                    shard.restore(row["block"], SWEEPS)
                    shard.told(_joined(answers), SWEEPS, last)
                else:
                    if row["block"] is not None:
                        words, counts, contexts, place, docs = unpacked_tokens(row["block"], "u4", "u4")
                        values = shard.scores(np.repeat(words, counts), contexts[place], last)
                        found = np.flatnonzero(np.bincount(docs))
                        sums = [np.bincount(docs, v)[found] for v in values]
                        row["block"] = packed(found.astype(np.uint16), *sums)
                    out.append(row)
            if out:
                yield record(out, COLUMNS, batch.schema)

    id_field = docs.schema[id_column].dataType.simpleString()
    rows = (table.where("kind = 'tokens'").select("kind", *COLUMNS)
            .unionByName(ready.withColumn("kind", F.lit("a block")), allowMissingColumns=True)
            .unionByName(inbox, allowMissingColumns=True))
    parts = (rows.repartition("shard").sortWithinPartitions("shard", "kind", "chunk")
             .mapInArrow(scored, SCHEMA.format(id=id_field)))
    out = summed(parts, ("base_score", "score", "n_known"))
    return out.select(
        F.col("id").alias(id_column), "train", "n_tokens", F.col("n_known").cast("long").alias("n_known"),
        F.lit(last.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def pitman_yor_query(docs: DataFrame) -> DataFrame:
    held_out = fold(F.col("doc_id"), 7) == 2
    scored = score_texts(docs.select("doc_id", "text", (~held_out).alias("train")), "train")
    return scored.select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
