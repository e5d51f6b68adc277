"""Wide all-text survey exports as CSV."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from scorelab import vocabulary as V


def read_survey_csv(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[str] | None = None,
    multi_line: bool = True,
    null_token: str = V.NULL_TOKEN,
) -> DataFrame:
    """Every column is text; nothing is inferred.  ``null_token`` reads as null.

    With ``multi_line`` quoted answers may hold line breaks, but then one file
    is one task: ship large exports as many files, or use ``read_split_csv``.  When no answer holds a line
    break, ``multi_line=False`` lets Spark split every file.  ``columns`` gives
    the full header and saves the small job that reads it.
    """
    reader = spark.read.options(header=True, multiLine=multi_line, escape='"', nullValue=null_token)
    if columns is not None:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    return reader.csv(path)


def write_survey_csv(df: DataFrame, path: str, null_token: str = V.NULL_TOKEN) -> None:
    """The inverse of :func:`read_survey_csv`; one file per partition, blanks kept."""
    df.write.options(
        header=True,
        escape='"',
        nullValue=null_token,
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(path)
