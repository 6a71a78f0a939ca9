import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, words long, rank int"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, ties, repeated rows and clashing names."""
    long = " ".join(f"word{i % 977}x{i % 31}" for i in range(9000))
    base = " ".join(f"alpha{i}" for i in range(60))
    near = base.replace("alpha30", "beta")
    rows = [
        (1, base, "en", "a", 1, 7, 1),
        (2, near, "en", "a", 1, 7, 1),
        (2, near, "en", "a", 1, 7, 1),
        (3, base, "en", None, 1, None, None),
        (4, None, None, "b", None, 7, 1),
        (5, "", "en", "b", 0, 7, 1),
        (6, "...  !!", "fr", "b", 7, 7, 1),
        (None, "le chat est sur la table et il dort bien", "fr", "b", 1, 7, 1),
        (7, long, "en", "c", 1, 7, 1),
        (8, f"{near}\nle chat\n\nunique line of this one", "fr", "c", 1, 7, 1),
        (9, f"{base}\nthe end", "en", "c", 1, 7, 1),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
