import pytest

EXTRA = "n_words int, hash string, row string, kept boolean, spans string, class string, key long, line int, pos string, gone string, piece int"


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (doc_id, text) pairs, with more columns whose names the operators use."""

    def make(pairs, lang="en", source="s"):
        rows = [(i, t, lang, source, None if t is None else len(t), *[None] * 11) for i, t in pairs]
        return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}")

    return make


@pytest.fixture(scope="session")
def odd_texts():
    """Nulls, empty and very long texts, ties and repeated rows."""
    long = " ".join(f"w{i * 7919 % 5003}" for i in range(30_000))
    plain = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    return [
        (1, None), (2, ""), (3, " \n\t\n "), (4, plain), (4, plain), (5, plain), (None, plain), (6, long), (7, long),
        (8, "é ß 日本語 \U0001f600 x"), (9, "a"), (None, None),
    ]
