import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use for their own columns.
CLASHING = ["score", "shard", "slot", "fp", "node", "root", "first", "line_", "text_", "removal_", "column_0_", "u", "v", "spans", "n", "task_", "hits"]


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.select("*", *(F.lit(name).alias(name) for name in CLASHING))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    long = " ".join(f"word{i % 977} of" for i in range(60_000))
    return [
        (1, "The cat sat on the mat and looked at the very old clock.\nAll rights reserved.", "en", "a", 80),
        (1, "The cat sat on the mat and looked at the very old clock.\nAll rights reserved.", "en", "a", 80),
        (2, "", "en", "b", 0), (3, None, "en", "c", None), (4, "   \n\t ", None, None, 6), (None, "only a text here", "de", "a", 16),
        (None, None, None, None, None), (5, long, "en", "b", len(long)), (6, "Ünïcode 漢字 ▁ \x00 ​ text", "de", "c", 20), (7, ".!?", "de", "c", 3),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The odd rows with extra columns whose names clash with the operators' own."""
    return with_clashes(spark.createDataFrame(odd_rows, SCHEMA)).cache()


@pytest.fixture(scope="session")
def none(spark):
    """An empty table with the same columns."""
    return with_clashes(spark.createDataFrame([], SCHEMA))
