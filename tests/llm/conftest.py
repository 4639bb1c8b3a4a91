import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that operators use inside, here as columns of the input.
CLASHES = ("_key", "row_key", "fingerprint", "line", "pos", "key", "_places", "whole", "last", "_times", "_level_0", "_best", "language", "component_id", "text_", "a.b")


def long_text(words: int) -> str:
    return " ".join(f"word{k % 977}x{k % 13}" for k in range(words))


def odd_rows():
    """Nulls in each column, empty and long texts, ties, repeated rows."""
    plain = "The river runs slowly past the old mill\nand the wheel has not turned for years.\nNobody minds."
    return [
        (1, plain, "en", "a.de", 10), (2, plain, "en", "b", 10), (2, plain, "en", "b", 10), (3, plain + " Now.", None, "c", None),
        (4, None, "en", "a.de", 0), (5, "", "en", None, 0), (5, "", "en", None, 0), (None, plain, "en", "d", 3), (None, None, None, None, None),
        (6, "\n\n \t\n", "en", "a.de", 5), (7, long_text(60_000), "en", "b", 7), (8, "x" * 200_000, "en", "b", 8),
        (9, "one", "en", "b", 3), (9, "two words", "en", "b", 3), (10, "😀é   ñ", "es", "c", 5), (11, "a " * 30_000, "en", "e", 1),
    ]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def clashing(odd):
    from pyspark.sql import functions as F

    return odd.withColumns({c: F.lit(f"old {c}") for c in CLASHES})


@pytest.fixture(scope="session")
def none(odd):
    return odd.filter("doc_id < 0")


@pytest.fixture(scope="session")
def given(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
