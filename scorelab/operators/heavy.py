"""Most frequent values from mergeable summaries, without a shuffle of all values."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from scorelab.functions.encode import named
from scorelab.operators.profiles import COUNT, frequencies
from scorelab.session import materialise

#: Values that a task keeps a counter for.
COUNTERS = 4096


def _reduced(table: pa.Table, counters: int) -> tuple[pa.Table, int]:
    """At most ``counters`` values of (value, n), and by how much any count fell."""
    if table.num_rows <= counters:
        return table, 0
    n = table.column("n").to_numpy()
    lost = int(np.partition(n, len(n) - counters - 1)[len(n) - counters - 1])
    left = table.set_column(1, "n", pa.array(n - lost))
    return left.filter(pa.array(n > lost)), lost


def frequency_summary(df: DataFrame, column: str, counters: int = COUNTERS) -> DataFrame:
    """(value, n, lost) rows: Misra-Gries counters of every task, and one row with n 0 for what it lost.

    Over the sum of any such rows, of tasks or of tables, a value's true count is between the sum
    of its n and that plus the sum of all lost, which is at most rows / (counters + 1).  Nulls
    are a value of their own.
    """
    kind = df.schema[column].dataType
    schema = StructType([StructField("value", kind), StructField("n", LongType()), StructField("lost", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, lost = None, 0
        for batch in batches:
            found = pa.table({"value": batch.column(0), "n": pa.array(np.ones(batch.num_rows, np.int64))})
            both = found if kept is None else pa.concat_tables([kept, found])
            counted = both.group_by("value").aggregate([("n", "sum")]).rename_columns({"n_sum": "n"}).select(["value", "n"])
            kept, fell = _reduced(counted, counters)
            lost += fell
        if kept is not None:
            yield from kept.append_column("lost", pa.array(np.zeros(kept.num_rows, np.int64))).to_batches()
            nothing = pa.nulls(1, kept.schema.field("value").type)
            yield pa.record_batch({"value": nothing, "n": pa.array([0], pa.int64()), "lost": pa.array([lost], pa.int64())})

    return df.select(named(column).alias("value")).mapInArrow(run, schema)


def heavy_hitters(df: DataFrame, column: str, k: int, counters: int = COUNTERS, count: str = COUNT) -> DataFrame:
    """The k most frequent values with exact counts, ties to the smaller value, as ``frequencies`` has them.

    Summaries are shuffled, at most ``counters`` rows a task.  If no task lost anything they are
    the counts.  Otherwise the k-th largest sum is a count that k values reach; if it is
    above what was lost, only values whose sum plus the loss reaches it can be among the k, and
    these are counted in a second pass.  If it is not, all values are counted.
    """
    summary = materialise(frequency_summary(df, column, counters), "summary")
    sums = summary.where("n > 0").groupBy("value").agg(F.sum("n").alias("n"))
    lost = summary.agg(F.coalesce(F.sum("lost"), F.lit(0)).alias("lost")).first().lost
    top = sums.orderBy(F.desc("n"), "value").limit(k)
    if not lost:
        return top.select(F.col("value").alias(column), F.col("n").alias(count)).orderBy(F.desc(count), named(column))
    reached = top.agg(F.count("*").alias("values"), F.min("n").alias("n")).first()
    if reached["values"] < k or reached.n <= lost:
        return frequencies(df, column, count).limit(k)
    # A written table of a few values a task: Spark broadcasts it if its size is small enough.
    candidates = materialise(sums.where(F.col("n") + lost >= reached.n).select("value"), "candidates")
    rows = df.select(named(column).alias("own")).alias("r").join(candidates, F.col("own").eqNullSafe(F.col("value")), "left_semi")
    return frequencies(rows.withColumnRenamed("own", column), column, count).limit(k)
