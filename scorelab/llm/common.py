"""Helpers that several operators share: texts in Arrow batches, span digests, folds."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 8 << 20


def reachable(spark: SparkSession) -> None:
    """Let Python workers look for this package where the client found it, besides their own path."""
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(":")
    if root not in paths:
        environment["PYTHONPATH"] = ":".join(filter(None, [*paths, root]))


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    reachable(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fold(doc_id: str | Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % folds


def small_slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each slice holds about ``limit`` bytes of text, one row at least.

    A batch of thousands of long texts would otherwise be unpacked into Python at once.
    """
    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        mean = max(1, batch.column(batch.schema.get_field_index(column)).nbytes // rows)
        step = max(1, min(rows, limit // mean))
        for start in range(0, rows, step):
            yield batch.slice(start, step)


def map_texts(df: DataFrame, rows_of: Callable[[list, list], dict[str, list]], schema: str, keys: tuple[str, str] = ("doc_id", "text")) -> DataFrame:
    """Run ``rows_of(ids, texts)`` over slices of two columns; one narrow pass, no shuffle."""
    from pyspark.sql.types import StructType

    id_column, text_column = keys
    types = StructType.fromDDL(schema)
    names = types.fieldNames()

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(types)
        for batch in small_slices(batches):
            found = rows_of(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(found[n], arrow.field(n).type) for n in names], schema=arrow)

    return df.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text")).mapInArrow(run, types)


def listed(spans: list[tuple[int, int, int]], kinds: tuple[str, ...]) -> str:
    """kind:start:end of (start, kind number, end) triples, by start, then kind."""
    return ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in sorted(spans))


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
