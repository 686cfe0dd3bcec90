"""Values that the SQL checks take from the library, written out once more."""

from pressroom.functions.tokens import ENGLISH_STOP_WORDS, FEED_STOP_WORDS, FULL_STOP_WORDS
from pressroom.operators import split
from pressroom.plans import features, models, tune
from pressroom.sources import store


def test_grids():
    assert tune.LR_RANGES == {
        "maxIter": [10, 50, 100, 200], "regParam": [0.0, 0.01, 0.1, 1.0], "elasticNetParam": [0.0, 0.5, 1.0],
        "tol": [1e-6, 1e-4, 1e-2], "fitIntercept": [True, False], "standardization": [True, False],
        "aggregationDepth": [2, 3, 4], "family": ["auto", "binomial", "multinomial"],
    }
    assert tune.NB_RANGES == {
        "smoothing": [0.0, 0.5, 1.0, 2.0], "modelType": ["multinomial", "bernoulli", "complement"]}
    assert tune.CROSS_VALIDATION_RANGES == {"regParam": [0.1, 0.3, 0.5], "elasticNetParam": [0.0, 0.1, 0.2]}
    assert (tune.FOLDS, tune.STOP_ABOVE) == (5, 0.95)


def test_training():
    assert models.MAIN_PARAMS == {"maxIter": 15, "regParam": 0.3, "elasticNetParam": 0.0}
    assert models.ROUNDS == 10 and features.COUNT_TERMS == 10_000 and split.BATCH_ROWS == 10_000
    assert split.MAIN_SPLIT == ([0.7, 0.3], 100) and split.TUNED_SPLIT == ([0.7, 0.2], 42)
    assert split.BOOSTED_SPLIT == ([0.8, 0.2], 42)


def test_words_and_missing_values():
    assert len(ENGLISH_STOP_WORDS) == 179 and len(FEED_STOP_WORDS) == 7
    assert set(FEED_STOP_WORDS) <= set(FULL_STOP_WORDS) and set(ENGLISH_STOP_WORDS) <= set(FULL_STOP_WORDS)
    assert store.CSV_MISSING == [
        "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
        "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
    ]
