import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "lorem ipsum dolor sit amet " * 4000


@pytest.fixture(scope="session")
def trap_docs(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns named like results."""
    rows = [
        (1, "The cat sat on the mat and looked at the dog.", "en", "a", 5),
        (2, "The cat sat on the mat and looked at the dog.", "en", None, 5),
        (3, None, None, "a", None),
        (4, "", "en", "b", 0),
        (5, LONG, "en", "b", len(LONG)),
        (6, "Der Hund sah die Katze und das Haus.", "de", "c", 1),
        (7, "12345 !!! ...", "de", "c", 1),
        (8, "é😀 ñandú  \t\n x", "es", "c", 1),
        (9, LONG + "end", None, "b", 1),
        (9, LONG + "end", None, "b", 1),
        (None, "The cat sat on the mat and looked at the dog.", "en", "a", 1),
        (10, "x", "en", "a", 1),
    ]
    df = spark.createDataFrame(rows, DOCS)
    return df.selectExpr("*", "1 AS score", "'q' AS shard", "2 AS keep_id", "3 AS _key", "4 AS Good",
                         "5 AS ids", "6 AS slot").repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
