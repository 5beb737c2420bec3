import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row_key string, spans string, _source string, score double"


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and very long texts, repeated rows, clashing names."""
    long_text = " ".join(f"word{i}" for i in range(30_000))
    texts = [
        (1, "The quick brown fox jumps over the lazy dog near the river bank", "en", "a"),
        (2, "The quick brown fox jumps over the lazy dog near the river bank", "en", "a"),
        (2, "The quick brown fox jumps over the lazy dog near the river bank", "en", "a"),
        (None, "le renard brun saute par dessus le chien paresseux", "fr", None),
        (4, None, None, "b"),
        (5, "", "en", "b"),
        (6, " \t\n ", None, "b"),
        (7, long_text, "en", "c"),
        (8, long_text, "fr", "c"),
        (9, "12345 67890 !!", "en", "c"),
        (10, "née élève été à la forêt \U0001f642 ▁ 日本語", "fr", "a"),
        (0, "one", "en", "a"),
    ]
    rows = [(*r, len(r[1] or ""), "k", "s", "x", 0.5) for r in texts]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)
