import pytest

WORD = r"[^\x20\x09-\x0D]+"
LONG = " ".join(f"w{i * 7919 % 1013}" for i in range(30_000))

# nulls in every column, empty, blank and very long texts, repeated rows, equal texts
EDGE = [
    (1, None, "en", "s1"),
    (2, "", "en", "s1"),
    (3, " \n\t \n", None, None),
    (None, "a text without an id stands here\nand a second line", "en", "s2"),
    (5, "same text repeated here now please\nthe end of it", "de", None),
    (5, "same text repeated here now please\nthe end of it", "de", None),
    (6, "same text repeated here now please\nthe end of it", "en", "s1"),
    (7, "x" * 200_000, "en", "s3"),
    (8, LONG, "fr", "s3"),
    (9, "same text repeated here now thanks\nİstanbul é 日本 'S don't!!", "en", "s2"),
    (10, "mail me: a.b@c.example or call +1 (706) 555-3138; 10.0.0.256 10.0.0.1", "en", "s2"),
]
EXTRA = "doc_id long, text string, lang string, source string, n_chars long, `__row` int, size string, c string, `__id` string, at int"


@pytest.fixture(scope="session")
def edge(spark):
    rows = [(i, t, lang, s, None if t is None else len(t), k, f"z{k}", None, "q", k)
            for k, (i, t, lang, s) in enumerate(EDGE)]
    return spark.createDataFrame(rows, EXTRA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], EXTRA)


@pytest.fixture(scope="session")
def sample(spark):
    """All documents of the smallest table."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
