import pytest

LONG = "word " * 9000 + "x" * 5000


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, extra clashing columns."""
    rows = [(0, "the quick brown fox jumps over the lazy dog", "en", 1), (1, None, None, None), (2, "", "en", 2),
            (3, " \t\n\r ", "en", 3), (4, LONG, "en", 4), (4, LONG, "en", 4), (None, "no id at all", "en", 5),
            (5, "don't <|endoftext|> stop\x1cnow é́ İx 12345 \U0001f600", "en", 6),
            (6, "the quick brown fox jumps over the lazy dog", "en", 7)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, ids long")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
