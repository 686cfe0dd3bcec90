"""The corpus pipeline: from documents to packed training sequences.

``STAGES`` are applied in order, each to all that its predecessor kept, written as Parquet between them.
All but the last return the columns of ``documents``. There is no SQL for the whole: two stages fit
models and one joins by random paths; the tests hold the result against plain Python instead.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressroom.llm.chosen_path import drop_near_duplicates
from pressroom.llm.common import table
from pressroom.llm.packing import packing_query
from pressroom.llm.rules import apply_policy, ledger
from pressroom.llm.toxicity import THRESHOLD, learned, scorer
from pressroom.session import write_and_read


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model of the labelled ones among them doesn't call toxic.

    Without labels nothing can be told, and all documents stay.
    """
    model = learned(docs, table(spark, sf_dir, "labels"))
    return docs.where(scorer(docs, model)(F.col("text")) < THRESHOLD)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass version 1 of the rules' policy; null and empty texts don't.

    The ledger is written first, so that another policy needs no second look at the texts.
    """
    return apply_policy(write_and_read(ledger(docs), "ledger"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each group linked by a Jaccard similarity of 0.8 or more."""
    return drop_near_duplicates(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens: where each begins, in text and sequence."""
    return packing_query(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", near_duplicates),
    ("best_fit_packing", packing),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each on what the one before kept."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_and_read(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
