"""The registered queries of this subpackage, one per operator, and the SQL for those that have one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pressroom.llm.bpe import bpe_query
from pressroom.llm.chosen_path import chosen_path_query
from pressroom.llm.common import table
from pressroom.llm.gnat import HARD_NEGATIVES_SQL, hard_negatives_query
from pressroom.llm.kneser_ney import kneser_ney_query
from pressroom.llm.p_stable import embedding_query
from pressroom.llm.packing import packing_query
from pressroom.llm.pitman_yor import pitman_yor_query
from pressroom.llm.rendezvous import SHARDS_SQL, shard_query
from pressroom.llm.rules import ABLATION_SQL, RULES_SQL, ablation_query, rules_query
from pressroom.llm.runs import runs_query
from pressroom.llm.toxicity import toxicity_query
from pressroom.llm.urls import url_query
from pressroom.llm.wordpiece import piece_query

BPE_JSON = public_tokenizers.path("byte_bpe_50k.json")
BPE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def _on(name: str, query: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """A query over one whole table."""
    return lambda spark, sf_dir: query(table(spark, sf_dir, name))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": _on("documents", lambda docs: packing_query(docs, BPE_JSON)),
    "op2_pitman_yor": _on("documents", pitman_yor_query),
    "op3_piece_counts": _on("documents", lambda docs: piece_query(docs, BPE_RANKS)),
    "op4_quality_rules": _on("documents", rules_query),
    "op5_embedding_near_dedup": _on("embeddings", embedding_query),
    "op6_byte_bpe": _on("documents", lambda docs: bpe_query(docs, BPE_RANKS)),
    "op7_kneser_ney": lambda spark, d: kneser_ney_query(table(spark, d, "documents"), table(spark, d, "labels")),
    "op8_toxicity": lambda spark, d: toxicity_query(table(spark, d, "documents"), table(spark, d, "labels")),
    "op9_chosen_path_join": _on("documents", chosen_path_query),
    "op10_url_filter": _on("pages", url_query),
    "op11_hard_negatives": _on("embeddings", hard_negatives_query),
    "rules_ablation": _on("documents", ablation_query),
    "op12_rendezvous_shards": _on("documents", shard_query),
    "op13_periodic_runs": _on("documents", runs_query),
}

ORACLE_SQL: dict[str, str] = {
    "op4_quality_rules": RULES_SQL,
    "rules_ablation": ABLATION_SQL,
    "op11_hard_negatives": HARD_NEGATIVES_SQL,
    "op12_rendezvous_shards": SHARDS_SQL,
}
