import pytest

SCHEMA = "doc_id long, text string, lang string, source string, extra string"
PROSE = "the quick brown fox jumps over a lazy dog while seven wise owls watch from tall trees near the old river bend"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, a repeated id, odd characters."""
    rows = [
        (1, PROSE, "en", "a", "x"),
        (2, PROSE, "en", "a", "x"),
        (2, PROSE, "en", "a", "x"),
        (3, None, None, None, None),
        (None, PROSE + " again", "en", "b", "x"),
        (None, None, None, None, None),
        (4, "", "en", "b", "x"),
        (5, " \t\n ", "en", "b", "x"),
        (6, "word", "de", "c", "x"),
        (7, " ".join(f"w{i % 997}" for i in range(60_000)), "de", "c", "x"),
        (8, "x" * 3_000_000, "de", "c", "x"),
        (9, "café 中文 \U0001f389 <|endoftext|> a   b\x00c", "fr", "é", "x"),
        (10, "12 34 !!", "fr", "é", "x"),
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def clash(docs, *names):
    """The documents with more columns, named like the operator's outputs."""
    from pyspark.sql import functions as F

    return docs.withColumns({n: F.lit("mine") for n in names})
