"""Small result sets as CSV reports and JSON records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from scorelab.functions.encode import named
from scorelab.sources.tables import is_missing_path


def write_report(
    df: DataFrame,
    path: str,
    single_file: bool = True,
    order_by: Sequence[tuple[str, bool]] = (),
) -> None:
    """CSV with a header.  ``single_file`` is for aggregated results only.

    ``repartition(1)`` instead of ``coalesce(1)`` keeps everything before the
    last exchange parallel; ``order_by``, as (column, descending) pairs, sorts
    inside that one file.
    """
    out = df.repartition(1) if single_file else df
    if order_by:
        out = out.sortWithinPartitions(
            *[named(c).desc() if descending else named(c) for c, descending in order_by]
        )
    out.write.mode("overwrite").csv(path, header=True)


def read_report(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """All parts of a report; FileNotFoundError when it was never written."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    try:
        return reader.csv(path)
    except AnalysisException as error:
        if is_missing_path(error):
            raise FileNotFoundError(f"no report at {path}") from error
        raise


def write_metrics(df: DataFrame, path: str) -> None:
    """A one-row record as JSON."""
    df.coalesce(1).write.mode("overwrite").json(path)


def read_metrics(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as error:
        if is_missing_path(error):
            raise FileNotFoundError(f"no metrics at {path}") from error
        raise
