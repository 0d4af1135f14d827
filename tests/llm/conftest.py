import pytest

DOCUMENT = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
#: Names that operators use for their own columns.
CLASHING = "part INT, parts INT, size STRING, digest STRING, fp STRING, score STRING, kept STRING, table INT, n INT, draw INT"


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows, ties, clashing names."""
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    long = " ".join(words[(i * i) % 10] + str(i % 7) for i in range(60_000))
    rows = [
        (1, "One two three four five six seven", "en", "a", 7),
        (2, "One two\tthree four  five six seven", "en", "a", None),
        (3, "one TWO three four five six seven", None, "b", 7),
        (4, "", "en", None, 0),
        (5, None, None, None, None),
        (6, " \n\t ", "de", "b", 4),
        (7, long, "en", "a", len(long)),
        (8, long, "en", "b", len(long)),
        (9, "12345 67890 !!", "de", "b", 14),
        (10, "Unterschied zwischen Äpfeln und Birnen\x1cnoch", "de", "b", 40),
        (10, "Unterschied zwischen Äpfeln und Birnen\x1cnoch", "de", "b", 40),
        (None, "ohne Nummer, 日本語 und ☃", None, "c", None),
        (None, None, None, None, None),
        (12, "a" * 300, "de", "", 300),
    ]
    clash = [(1, 2, "x", None, "y", "z", None, 3, 4, 5)] * len(rows)
    return spark.createDataFrame([r + c for r, c in zip(rows, clash)], f"{DOCUMENT}, {CLASHING}")


@pytest.fixture(scope="module")
def empty(docs):
    return docs.filter("false")


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")
