"""Global order without a global sort in one task: running totals and medians."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorelab.functions.encode import named
from scorelab.session import materialise


def _ranged(df: DataFrame, groups: Sequence[str], order: str) -> DataFrame:
    """Rows in value ranges of about equal count, one per task, with the range's number as ``_range``.

    Equal values share a range.  The table is written, so that offsets and rows are
    read from one and the same cut whatever is computed again later.
    """
    ordered = df.repartitionByRange(*[named(c) for c in [*groups, order]])
    return materialise(ordered.withColumn("_range", F.spark_partition_id()), "ranges")


def _offsets(ranged: DataFrame, groups: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Per group and range the sums, the totals over earlier ranges and the group's totals."""
    totals = ranged.groupBy(*groups, "_range").agg(*[F.sum(named(s)).alias(f"_{s}_here") for s in sums])
    everyone = Window.partitionBy(*groups)
    earlier = everyone.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumns(
        {f"_{s}_offset": F.coalesce(F.sum(f"_{s}_here").over(earlier), F.lit(0)) for s in sums}
        | {f"{s}_total": F.sum(f"_{s}_here").over(everyone) for s in sums}
    )


def _add_running(located: DataFrame, groups: Sequence[str], order: str, sums: Sequence[str]) -> DataFrame:
    inside = (
        Window.partitionBy(*groups, "_range").orderBy(named(order)).rowsBetween(Window.unboundedPreceding, -1)
    )
    return located.withColumns(
        {
            f"{s}_before": F.col(f"_{s}_offset") + F.coalesce(F.sum(named(s)).over(inside), F.lit(0))
            for s in sums
        }
    )


def running_totals(df: DataFrame, groups: Sequence[str], order: str, sums: Sequence[str]) -> DataFrame:
    """Add ``<sum>_before``, the total of ``sum`` over smaller ``order`` values, and
    ``<sum>_total``.

    ``df`` holds one row per (groups, order) value.  Rows are dealt into value
    ranges, as many as the session has shuffle partitions; totals per range give
    offsets, and a window per range does the rest.  So no task sorts a whole group,
    however many values it has.
    """
    ranged = _ranged(df, groups, order)
    located = ranged.join(_offsets(ranged, groups, sums), [*groups, "_range"])
    return _add_running(located, groups, order, sums).select(
        *[named(c) for c in df.columns], *[f"{s}_before" for s in sums], *[f"{s}_total" for s in sums]
    )


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n) for several numeric columns, counted in a single pass.

    Null and NaN are no values.
    """
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), named(c).cast("double").alias("value")) for c in columns]
    )
    return (
        df.select(F.inline(pairs))
        .where(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def median_cuts(df: DataFrame, columns: Sequence[str], method: str = "sliced", accuracy: int = 1000) -> DataFrame:
    """One row with the lower median of each column, itself a value of the data.

    ``sliced``      exact for any column: counts equal values, deals them into value
                    ranges, and ranks only those in the range with the middle rank.
    ``few_values``  exact with fewer steps, for columns whose number of distinct
                    values is small by construction: ranks all distinct values.
    ``sketch``      a quantile sketch with relative error ``1/accuracy``, one pass.
    """
    if method == "sketch":
        known = [F.when(~F.isnan(named(c).cast("double")), named(c)) for c in columns]
        return df.agg(*[F.percentile_approx(value, 0.5, accuracy).alias(c) for c, value in zip(columns, known)])
    counts = value_counts(df, columns)
    rank = F.ceil(F.col("n_total") / 2)
    if method == "few_values":
        everyone = Window.partitionBy("column")
        smaller = everyone.orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
        ranked = counts.withColumns(
            {"n_total": F.sum("n").over(everyone), "n_before": F.coalesce(F.sum("n").over(smaller), F.lit(0))}
        )
    elif method == "sliced":
        ranged = _ranged(counts, ["column"], "value")
        located = ranged.join(_offsets(ranged, ["column"], ["n"]), ["column", "_range"]).where(
            (F.col("_n_offset") < rank) & (F.col("_n_offset") + F.col("_n_here") >= rank)
        )
        ranked = _add_running(located, ["column"], "value", ["n"])
    else:
        raise ValueError(f"unknown method {method}")
    middle = ranked.where((F.col("n_before") < rank) & (F.col("n_before") + F.col("n") >= rank))
    return middle.agg(*[F.max(F.when(F.col("column") == c, F.col("value"))).alias(c) for c in columns])
