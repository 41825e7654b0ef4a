import pytest

SF = "/root/testdata/sf0.001"
EXTRA = "doc_id bigint, text string, source string, lang string, n_chars bigint, kept string, n_words int, shard string, id string"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def edge_docs(spark):
    """NULLs in every column, empty and very long texts, ties, repeated rows, extra columns with clashing names."""
    long = " ".join(f"w{i}x" for i in range(60_000))
    rows = [
        (1, None, None, None, None, "a", 1, "s", None),
        (None, "some words here and there", "s1", "en", 5, None, None, None, "x"),
        (2, "", "s1", "en", 0, "b", 2, None, "y"),
        (3, long, "s2", "en", len(long), "c", 3, None, None),
        (4, " \t\n\x0b ", "s2", None, 5, "c", 3, None, None),
        (5, "The same text, twice in the table, with the same id.", "s1", "en", 9, None, 1, "k", "z"),
        (5, "The same text, twice in the table, with the same id.", "s1", "en", 9, None, 1, "k", "z"),
        (6, "The same text, twice in the table, with the same id.", "s1", "en", 9, None, 1, "k", "z"),
        (7, "one\n\none\n\n  \nTwo three", "s1", "en", 9, None, 1, "k", "z"),
        (8, long.replace("w5x", "v5x"), "s2", "en", len(long), "c", 3, None, None),
        (-9, "Ünïcödé É wörds\nÜnïcödé É wörds 😀", "", "de", 3, "c", 3, None, None),
    ]
    return spark.createDataFrame(rows, EXTRA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], EXTRA)
