import pytest

from starledger.llm.common import ship_package

DOC = "doc_id long, text string, lang string, source string, n_chars long, uid long"


@pytest.fixture(scope="session")
def lspark(spark):
    ship_package(spark)
    return spark


@pytest.fixture(scope="session")
def small_docs(lspark):
    """Nulls in every column, empty and long texts, copies, repeated rows, a
    clashing extra column (``uid``)."""
    base = " ".join(f"word{i % 97} item{i % 31}" for i in range(400))
    rows = [(1, base, "en", "a", len(base), 7), (2, base, "en", "a", len(base), 7), (2, base, "en", "a", len(base), 7),
            (3, base + " tail", "en", "b", 1, 7), (4, None, None, None, None, None), (5, "", "de", "b", 0, 7),
            (6, " \t\n", "de", "b", 3, 7), (None, "lonely text without an id", "en", "a", 25, 7), (7, "Größe 東京 🙂 'tis <|endoftext|> x", "de", None, 30, 7),
            (8, "a" * 30_000, "en", "c", 30_000, 7), (9, "one", "en", "c", 3, 7)]
    return lspark.createDataFrame(rows, DOC)
