import pytest

DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """Documents from ``(doc_id, text, lang, source)`` rows."""

    def make(rows, schema=DOCUMENT):
        full = [(*r, *([None] * (4 - len(r))), len(r[1]) if r[1] is not None else None) for r in rows]
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture
def odd(documents):
    """NULLs in every column, empty, blank and very long texts, repeated rows and equal keys."""
    long = " ".join(f"word{i % 977}" for i in range(60_000))
    return documents(
        [
            (1, "the quick brown fox jumps over the lazy dog", "en", "a"),
            (1, "the quick brown fox jumps over the lazy dog", "en", "a"),
            (2, "the quick brown fox jumps over the lazy dog", "en", "b"),
            (3, None, "en", "a"),
            (4, "", None, None),
            (5, " \n\t ", "de", "b"),
            (6, long, "en", "a"),
            (None, "und wieder ein ganz anderer Text", "de", None),
            (None, "und wieder ein ganz anderer Text", "de", None),
            (None, None, None, None),
            (7, "7 8 9 !", None, "c"),
            (8, "日本語 \U0001f600 é", None, "c"),
        ]
    )
