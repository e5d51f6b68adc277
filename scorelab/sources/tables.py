"""Parquet tables, named views and late-bound column selection."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import urlparse

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from scorelab.functions.encode import named


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def is_missing_path(error: AnalysisException) -> bool:
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_optional_table(spark: SparkSession, path: str, kind: str = "parquet") -> DataFrame | None:
    """The table, or None when there is nothing at ``path``."""
    try:
        return spark.read.format(kind).load(path)
    except AnalysisException as error:
        if is_missing_path(error):
            return None
        raise


def _root_paths(df: DataFrame) -> list[str]:
    """The paths the plan's file relations were opened with: a few names, never a listing of files."""
    paths = []
    leaves = df._jdf.queryExecution().analyzed().collectLeaves().iterator()
    while leaves.hasNext():
        leaf = leaves.next()
        if leaf.getClass().getSimpleName() == "LogicalRelation" and leaf.relation().getClass().getSimpleName() == "HadoopFsRelation":
            roots = leaf.relation().location().rootPaths().iterator()
            while roots.hasNext():
                paths.append(roots.next().toString())
    return paths


def _overlap(one: str, other: str) -> bool:
    """Whether one path is the other or lies below it."""
    a, b = (urlparse(p).path.rstrip("/") + "/" for p in (one, other))
    return a.startswith(b) or b.startswith(a)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a Parquet table.  ``path`` must not be among the plan's own inputs:
    overwriting removes the old files before the new ones are computed."""
    if any(_overlap(used, path) for used in _root_paths(df)):
        raise ValueError(f"{path} is read by this plan; write elsewhere")
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def register_table(df: DataFrame, name: str) -> DataFrame:
    """Name a DataFrame for SQL text."""
    df.createOrReplaceTempView(name)
    return df


def select_available(df: DataFrame, wanted: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Keep the wanted columns that exist, and say which do not."""
    present = set(df.columns)
    missing = [c for c in wanted if c not in present]
    return df.select(*[named(c) for c in wanted if c in present]), missing
