"""Feature pipelines: text to vectors, category to label."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import Normalizer, SQLTransformer

from pressroom.functions.tokens import (
    ENGLISH_STOP_WORDS,
    FEED_STOP_WORDS,
    gap_tokenizer,
    match_tokenizer,
    stop_word_remover,
)
from pressroom.operators.labels import alphabetical_indexer, frequency_indexer
from pressroom.operators.vectors import SmoothIdfScaler, TermTable, VocabularyVectorizer

# Fixed value: terms in the count vocabulary.
COUNT_TERMS = 10_000


def _fill_text() -> SQLTransformer:
    # The tokenizer fails on null, so every pipeline reads null text as empty.
    return SQLTransformer(statement="SELECT *, coalesce(text, '') AS filled_text FROM __THIS__")


def count_pipeline(
    stop_words: list[str] = FEED_STOP_WORDS, vocab_size: int = COUNT_TERMS, binary: bool = False
) -> Pipeline:
    """Gap tokens, stop words, counts over the most frequent terms."""
    return Pipeline(
        stages=[
            _fill_text(),
            gap_tokenizer("filled_text"),
            stop_word_remover(stop_words),
            VocabularyVectorizer(
                inputCol="filtered", outputCol="features", vocabSize=vocab_size, binary=binary
            ),
        ]
    )


def tfidf_pipeline(
    stop_words: list[str] = ENGLISH_STOP_WORDS, vocab_size: int = 0
) -> Pipeline:
    """Match tokens, stop words, TF-IDF of length 1. ``vocab_size=0`` keeps the whole vocabulary."""
    return Pipeline(
        stages=[
            _fill_text(),
            match_tokenizer("filled_text"),
            stop_word_remover(stop_words),
            VocabularyVectorizer(inputCol="filtered", outputCol="counts", vocabSize=vocab_size),
            SmoothIdfScaler(inputCol="counts", outputCol="weights"),
            Normalizer(inputCol="weights", outputCol="features", p=2.0),
        ]
    )


def term_table_pipeline(
    stop_words: list[str] = ENGLISH_STOP_WORDS, id_col: str = "doc_id", path: str | None = None
) -> Pipeline:
    """Match tokens, stop words, TF-IDF over a written table of all terms.

    The same numbers as ``tfidf_pipeline`` without any node holding the vocabulary; ``features`` is a
    struct of ``indices`` and ``values``, for boosting and for tables rather than for the library's
    models, whose coefficients are dense.
    """
    return Pipeline(
        stages=[
            _fill_text(),
            match_tokenizer("filled_text"),
            stop_word_remover(stop_words),
            TermTable(inputCol="filtered", outputCol="features", idCol=id_col, path=path),
        ]
    )


def label_pipeline(order: str = "frequency") -> Pipeline:
    """Category to label, by frequency or alphabetically. Apart from the text stages, since
    unlabelled text passes only through those."""
    indexer = frequency_indexer() if order == "frequency" else alphabetical_indexer()
    return Pipeline(stages=[indexer])
