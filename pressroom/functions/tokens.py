"""Tokenizers, stop words and per-text term counts."""

from __future__ import annotations

from pyspark.ml.feature import RegexTokenizer, StopWordsRemover
from pyspark.sql import Column
from pyspark.sql import functions as F

# The short stop-word list of the main trainer.
FEED_STOP_WORDS = ["http", "https", "amp", "rt", "t", "c", "the"]

# The public English stop-word list of the NLTK corpus (179 words).
ENGLISH_STOP_WORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves
he him his himself she she's her hers herself it it's its itself they them their theirs themselves
what which who whom this that that'll these those am is are was were be been being have has had
having do does did doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down in out on off over
under again further then once here there when where why how all any both each few more most other
some such no nor not only own same so than too very s t can will just don don't should should've
now d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn
hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn
shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
""".split()

# What the tuned count pipelines remove.
FULL_STOP_WORDS = ENGLISH_STOP_WORDS + FEED_STOP_WORDS


def gap_tokenizer(input_col: str = "text", output_col: str = "words") -> RegexTokenizer:
    """Lower-case and split on ASCII non-word characters, so ``Café`` gives ``caf``."""
    return RegexTokenizer(inputCol=input_col, outputCol=output_col, pattern="\\W")


def match_tokenizer(input_col: str = "text", output_col: str = "words") -> RegexTokenizer:
    """Lower-case and keep runs of Unicode word characters, so ``Café`` gives ``café``."""
    return RegexTokenizer(inputCol=input_col, outputCol=output_col, pattern="(?U)\\w+", gaps=False)


def stop_word_remover(
    stop_words: list[str], input_col: str = "words", output_col: str = "filtered"
) -> StopWordsRemover:
    # An explicit locale keeps results independent of the JVM's default one.
    return StopWordsRemover(
        inputCol=input_col, outputCol=output_col, stopWords=stop_words, locale="en_US"
    )


def term_counts(tokens: Column) -> Column:
    """Distinct terms of one text with their counts: ``array<struct<term, n>>``, sorted by term.

    Runs inside the row: sort the tokens, find where each run starts, and take the distance to
    the next start. A text is never split over tasks, so counting needs no shuffle.
    """

    def runs(words: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(words) - 1),
            lambda i: (i == 0) | (F.get(words, i) != F.get(words, i - 1)),
        )
        # Binding the starts to a lambda variable keeps them from being computed per element.
        return F.get(
            F.transform(
                F.array(starts),
                lambda at: F.transform(
                    at,
                    lambda start, k: F.struct(
                        F.get(words, start).alias("term"),
                        (F.coalesce(F.get(at, k + 1), F.size(words)) - start)
                        .cast("long")
                        .alias("n"),
                    ),
                ),
            ),
            F.lit(0),
        )

    counted = F.get(F.transform(F.array(F.sort_array(tokens)), runs), F.lit(0))
    return F.when(F.size(tokens) > 0, counted)
