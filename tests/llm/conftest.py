import pytest

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i % 977} of the" for i in range(20_000))


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, clashing extra columns."""
    base = "the quick brown fox jumps over a lazy dog and runs to the old river bank with its friend again "
    rows = [
        (1, base * 2, "en", "a", 5, "x"), (1, base * 2, "en", "a", 5, "x"), (2, base * 2 + "tail", "en", "b", None, None),
        (3, None, "en", None, 1, "y"), (4, "", None, "a", 1, "y"), (5, " \t\n\x0b\x0c\r ", "en", "a", 1, "y"),
        (None, base + "und der die das", "de", "a", 1, "y"), (None, None, None, None, None, None),
        (6, LONG, "en", "c", 1, "y"), (7, "x" * 50_000, "xx", "c", 1, "y"), (7, "same id, other text", "en", "c", 1, "y"),
        (8, "<|endoftext|> é 漢字 \U0001f600 é z", "zz", "ü", 1, "y"), (9, "the", "en", "\U0001f600", 1, "y"),
        (2 ** 62, "a # b $ c\na # b $ c\n\n a # b $ c\n", "en", "a", 1, "y"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, size int, th string").selectExpr(
        "*", "'z' AS ids", "1 AS shard", "2 AS n_words", "3 AS taken", "4 AS _b", "5 AS _id", "6 AS rank", "7 AS kept",
        "length(text) AS n_chars")


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
