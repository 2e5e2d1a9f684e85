import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, copies string, h long"


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, extra columns with clashing names."""
    body = " ".join(f"word{i % 97}x{i % 13}" for i in range(300))
    rows = [
        (1, body, "en", "a", 1, "x", 1), (2, body, "en", "a", 1, "x", 1), (2, body, "en", "a", 1, "x", 1),
        (3, body.replace("word5x5", "other"), None, "b", None, None, None),
        (4, None, "en", "a", 0, "x", 0), (5, "", "en", None, 0, "x", 0), (6, "   \n\t ", "de", None, 3, "x", 0),
        (None, "the quick brown fox jumps over the lazy dog", "en", "c", 9, "x", 0), (8, "!!! ???", "en", "c", 7, "x", 0),
        (9, "der schnelle braune Fuchs springt über den faulen Hund", "de", "d", 9, "x", 0),
        (10, " ".join(f"long{i}" for i in range(60_000)), "en", "c", 9, "x", 0),
        (11, "one", "en", "c", 9, "x", 0), (12, "日本語 — текст × «x»", None, "d", 9, "x", 0),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)
