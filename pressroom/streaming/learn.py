"""A naive Bayes model kept current from a stream, and scoring by its latest state.

What the model knows is counts, and counts add up: each batch writes its own, in a folder of its number,
and the model is their sum. A batch that is run again replaces what it wrote, so a replay changes
nothing. The whole vocabulary counts; nothing of it passes through the driver but the classes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pressroom.functions.tokens import FEED_STOP_WORDS, gap_tokenizer, stop_word_remover
from pressroom.operators.blocks import column_of, encoded, list_of, with_block_terms
from pressroom.session import write_and_read

#: A term's occurrences in a category, or, where the term is null, the category's rows.
COUNTS = "category string, term string, n long"


def _tokens(df: DataFrame, *keep: str) -> DataFrame:
    """``(…keep, filtered)``: the terms of ``text``."""
    filled = df.select(*keep, F.coalesce("text", F.lit("")).alias("text"))
    return stop_word_remover(FEED_STOP_WORDS).transform(gap_tokenizer().transform(filled)).select(*keep, "filtered")


def batch_counts(df: DataFrame) -> DataFrame:
    """The counts of ``(text, category)`` rows; those without a category tell nothing."""
    known = df.where("category IS NOT NULL")
    # the outer form, since an inner one infers a filter that would run the tokenizer a second time
    words = _tokens(known, "category").select("category", F.explode_outer("filtered").alias("term"))
    terms = words.where("term IS NOT NULL").groupBy("category", "term").agg(F.count(F.lit(1)).alias("n"))
    rows = known.groupBy("category").agg(F.count("*").alias("n"))
    return terms.unionByName(rows.withColumn("term", F.lit(None).cast("string")))


def learn_batch(df: DataFrame, path: str, batch: int, source: str = "main") -> None:
    """Add one batch to the model at ``path``. The same ``source`` and number replace what they wrote."""
    batch_counts(df).write.mode("overwrite").parquet(f"{path}/source={source}/batch={batch}")


def start_learning(
    stream: DataFrame, path: str, checkpoint: str, source: str = "main", period: str | None = None
) -> StreamingQuery:
    """Keep the model at ``path`` current from ``(text, category)`` records.

    One ``source`` has one checkpoint: batches are known by their number there. Without ``period`` it
    takes what is there and ends.
    """
    trigger = {"processingTime": period} if period else {"availableNow": True}
    return (
        stream.writeStream.foreachBatch(lambda df, batch: learn_batch(df, path, batch, source))
        .option("checkpointLocation", checkpoint).trigger(**trigger).start())


def counts_so_far(spark: SparkSession, path: str) -> DataFrame:
    """The sum of all batches learned."""
    return spark.read.schema(COUNTS).parquet(f"{path}/source=*/batch=*").groupBy("category", "term").agg(
        F.sum("n").alias("n"))


def compact(spark: SparkSession, path: str, into: str) -> None:
    """Write the sum of all batches as the only batch of a new model, for fewer files."""
    counts_so_far(spark, path).write.parquet(f"{into}/source=compacted/batch=0")


def classify(df: DataFrame, id_col: str, counts: DataFrame, smoothing: float = 1.0) -> DataFrame:
    """``(id, predicted)`` of texts under multinomial naive Bayes with those counts.

    Terms that no class has are left out. Without any counts every prediction is null. Ids must be
    distinct.
    """
    counts = write_and_read(counts, "counts-so-far")
    terms = counts.where("term IS NOT NULL")
    tokens = terms.groupBy("category").agg(F.sum("n").alias("tokens"))
    classes = (counts.where("term IS NULL").select("category", F.col("n").alias("rows"))
               .join(tokens, "category", "left").orderBy(F.desc("rows"), "category").collect())  # a row per class
    if not classes:
        return df.select(id_col, F.lit(None).cast("string").alias("predicted"))
    by_class = F.map_from_entries(F.collect_list(F.struct("category", "n")))
    by_term = write_and_read(terms.groupBy("term").agg(by_class.alias("c"), F.sum("n").alias("total")).select(
        "term", "total", F.array(*(
            F.coalesce(F.try_element_at("c", F.lit(r["category"])), F.lit(0)) for r in classes)).alias("c")), "term-classes")
    vocabulary = by_term.count()
    rows, found = encoded(_tokens(df, id_col), "filtered", id_col)
    totals = [(r["tokens"] or 0) + smoothing * vocabulary for r in classes]

    def add_up(part: pa.Table, row: np.ndarray, n: np.ndarray, at: np.ndarray, known: pa.Table) -> pa.Table:
        counts = list_of(column_of(known, "c"))[0].reshape(-1, len(totals))
        with np.errstate(divide="ignore"):
            rates = np.log(counts + smoothing) - np.log(np.array(totals))
        rates[~np.isfinite(rates)] = 0.0  # without smoothing, what a class lacks tells nothing
        sums = [np.bincount(row, n * rates[at, k], part.num_rows) for k in range(len(totals))]
        return pa.table([part.column(id_col), *(pa.array(x, pa.float64()) for x in sums)],
                        names=["_id", *(f"_s{k}" for k in range(len(totals)))])

    sums = with_block_terms(
        rows, found, by_term, ["c"], add_up, T.StructType([
            T.StructField("_id", rows.schema[id_col].dataType),
            *(T.StructField(f"_s{k}", T.DoubleType()) for k in range(len(totals)))]))
    # the rows of an id that comes again are scored together
    sums = sums.groupBy("_id").agg(*(F.sum(f"_s{k}").alias(f"_s{k}") for k in range(len(totals))))
    scores = F.array(*(
        F.coalesce(F.col(f"_s{k}"), F.lit(0.0)) + F.log(F.lit(r["rows"] + smoothing)) for k, r in enumerate(classes)))
    names = F.array(*(F.lit(r["category"]) for r in classes))
    rows = df.select(id_col)
    scored = rows.join(sums, rows[id_col].eqNullSafe(sums["_id"]), "left").withColumn("_scores", scores)
    best = F.array_position("_scores", F.array_max("_scores")).cast("int") - 1
    return scored.select(id_col, F.get(names, best).alias("predicted"))


def start_scoring_latest(
    stream: DataFrame, id_col: str, path: str, out_path: str, checkpoint: str, period: str | None = None
) -> StreamingQuery:
    """Classify records as they arrive, each batch by what the model at ``path`` knows by then.

    A batch writes ``(id, predicted)`` to a folder of its number, so one that is run again replaces
    what it wrote.
    """

    def score(df: DataFrame, batch: int) -> None:
        classify(df, id_col, counts_so_far(df.sparkSession, path)).write.mode("overwrite").parquet(
            f"{out_path}/batch={batch}")

    trigger = {"processingTime": period} if period else {"availableNow": True}
    return (
        stream.writeStream.foreachBatch(score).option("checkpointLocation", checkpoint).trigger(**trigger).start())
