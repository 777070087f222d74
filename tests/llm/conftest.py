import pytest

TEXT = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source) rows."""

    def make(rows):
        full = [(r[0], r[1], *(r[2:] or ("en", "s")), len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, TEXT)

    return make


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty, blank, repeated rows, repeated ids, other scripts and a very long text."""
    long = " ".join(f"word{i % 977} and{i % 13}" for i in range(40_000))
    return [
        (1, None), (2, ""), (3, "   \n\t "), (4, "one two three four five six"), (4, "one two three four five six"),
        (5, "one two three four five six"), (None, "no id here at all, none"), (6, "日本語 текст Ελληνικά"), (7, long), (8, long), (9, "!!! 123 ###"),
        (5, "another text of the same id"),
    ]
