import pytest

from llm_helpers import odd_texts


@pytest.fixture(scope="session")
def odd(spark):
    """Odd rows, with columns whose names operators use inside."""
    rows = [(i, t, "x", i % 3, b"y") for i, t in enumerate(odd_texts())] + [(1, "", "x", 0, b"y"), (None, "one", "x", 1, b"y")]
    return spark.createDataFrame(
        rows, "doc_id long, text string, node string, length int, block binary").coalesce(2).cache()


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
