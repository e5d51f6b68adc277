"""Group profiles, rankings, pivots and slices."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorelab import vocabulary as V
from scorelab.functions.encode import as_column, named, ranked

COUNT = "DeveloperCount"


def known(column: Column | str, sentinel: str = V.UNKNOWN) -> Column:
    source = as_column(column)
    return source.isNotNull() & (source != F.lit(sentinel))


def profile(
    df: DataFrame,
    keys: Sequence[Column | str],
    means: Mapping[str, Column | str],
    min_count: int | None = None,
    count: str = COUNT,
    order: Sequence[Column] = (),
) -> DataFrame:
    """Group size and means.  The size counts all rows, each mean skips its own
    nulls, groups below ``min_count`` go, and keys break ties in the order."""
    grouped = df.groupBy(*[as_column(k) for k in keys]).agg(
        F.count(F.lit(1)).alias(count), *[F.avg(as_column(c)).alias(name) for name, c in means.items()]
    )
    if min_count is not None:
        grouped = grouped.where(F.col(count) >= min_count)
    if order:
        ties = [named(c) for c in grouped.columns[: len(keys)]]
        grouped = grouped.orderBy(*order, *ties)
    return grouped


def summary(df: DataFrame, distinct: Mapping[str, str], present: Mapping[str, str], means: Mapping[str, str],
            total: str = "TotalResponses") -> DataFrame:
    """One row: rows, non-null counts, distinct counts and means.

    Rows are first reduced to one partial record per combination of the distinct
    columns; several COUNT(DISTINCT) over raw rows would multiply the input.
    """
    keys = list(dict.fromkeys(distinct.values()))
    measured = list(dict.fromkeys(means.values()))
    partial = df.groupBy(*[named(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(named(c)).alias(f"_present_{name}") for name, c in present.items()],
        *[F.sum(named(c)).alias(f"_sum_{c}") for c in measured],
        *[F.count(named(c)).alias(f"_n_{c}") for c in measured],
    )
    return partial.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias(total),
        *[F.coalesce(F.sum(f"_present_{name}"), F.lit(0)).alias(name) for name in present],
        *[F.countDistinct(named(c)).alias(name) for name, c in distinct.items()],
        *[F.try_divide(F.sum(f"_sum_{c}"), F.sum(f"_n_{c}")).alias(name) for name, c in means.items()],
    )


def frequencies(df: DataFrame, column: str, count: str = COUNT) -> DataFrame:
    """Rows per category, most frequent first."""
    return profile(df, [column], {}, count=count, order=[F.col(count).desc()])


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: count, mean, sample deviation, min, max; single pass."""
    measures = {
        "Count": F.count, "Mean": F.avg, "StdDev": F.stddev_samp, "Min": F.min, "Max": F.max,
    }
    wide = df.agg(
        *[
            F.struct(
                F.lit(c).alias("Column"),
                *[fn(named(c).cast("double")).alias(name) for name, fn in measures.items()],
            ).alias(f"_{i}")
            for i, c in enumerate(columns)
        ]
    )
    return wide.select(F.inline(F.array(*[F.col(f"_{i}") for i in range(len(columns))])))


def ordered_by_category(df: DataFrame, column: str, order: Sequence[str], position: str | None = None,
                        ascending: bool = True) -> DataFrame:
    """Sort a report by a declared category order; ``position`` adds 0,1,2,..."""
    rank = ranked(column, order)
    sort = rank.asc() if ascending else rank.desc()
    if position is None:
        return df.orderBy(sort, named(column))
    window = Window.orderBy(sort, named(column))  # reports are a few rows
    return df.withColumn(position, (F.row_number().over(window) - 1).cast("long")).orderBy(position)


def top_k(df: DataFrame, value: str, k: int, ties: Sequence[str], ascending_output: bool = True) -> DataFrame:
    """The k largest, ties broken by key; shown from small to large by default."""
    largest = df.orderBy(named(value).desc(), *[named(t) for t in ties]).limit(k)
    return largest.orderBy(named(value), *[named(t).desc() for t in ties]) if ascending_output else largest


def extremes(df: DataFrame, key: str, value: str, bottom: int, top: int) -> DataFrame:
    """The lowest and highest groups with a known value, in one ascending list, none twice."""
    rated = df.where(named(value).isNotNull())
    lowest = rated.orderBy(named(value), named(key)).limit(bottom)
    highest = rated.orderBy(named(value).desc(), named(key)).limit(top)
    return lowest.unionByName(highest).dropDuplicates([key]).orderBy(named(value), named(key))


def extreme_rows(df: DataFrame, key: str, value: str) -> DataFrame:
    """One row: the keys and values of the highest and lowest group."""
    high = F.max(F.struct(named(value), named(key)))
    low = F.min(F.struct(named(value), named(key)))
    return df.where(named(value).isNotNull()).agg(high.alias("_high"), low.alias("_low")).select(
        F.col("_high").getField(key).alias("HighestKey"),
        F.col("_high").getField(value).alias("HighestValue"),
        F.col("_low").getField(key).alias("LowestKey"),
        F.col("_low").getField(value).alias("LowestValue"),
    )


def spread(df: DataFrame, value: str, key: str | None = None, excluding: str | None = None,
           name: str = "Spread") -> DataFrame:
    """Largest minus smallest group value, optionally without the sentinel group."""
    rows = df if excluding is None else df.where(named(key) != F.lit(excluding))
    return rows.agg((F.max(named(value)) - F.min(named(value))).alias(name))


def with_share(df: DataFrame, count: str = COUNT, total: DataFrame | None = None, name: str = "Share") -> DataFrame:
    """Percentage of ``total`` (a one-value frame), or of the sum of this report."""
    whole = (total if total is not None else df.agg(F.sum(named(count)))).scalar()
    return df.withColumn(name, F.try_divide(named(count) * F.lit(100.0), whole.cast("double")))


def with_median_flag(df: DataFrame, value: str, scope: DataFrame | None = None, name: str = "AboveMedian") -> DataFrame:
    """True at or above the interpolated median of ``scope`` (default: of this report)."""
    reference = scope if scope is not None else df
    return df.withColumn(name, named(value) >= reference.agg(F.median(named(value))).scalar())


def pivot_counts(df: DataFrame, row: str, column: str, value: str, columns: Sequence[str],
                 skip_absent: bool = False) -> DataFrame:
    """Rows by declared columns, summed, 0 where missing.

    Declared columns keep this one pass.  ``skip_absent`` looks up which of them
    occur (at most one value each comes back) and leaves out the others.
    """
    if skip_absent:
        found = df.where(named(column).isin(*columns)).select(named(column)).distinct().collect()
        present = {r[0] for r in found}
        columns = [c for c in columns if c in present]
    return df.groupBy(named(row)).pivot(column, list(columns)).agg(F.sum(named(value))).na.fill(0, list(columns))


def keep_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is among ``keys``; Spark picks the join from the real size."""
    return df.join(keys.select(named(key)), key, "left_semi")


def slice_rows(
    df: DataFrame,
    members: Mapping[str, Sequence[str]] | None = None,
    years: tuple[float | None, float | None] = (None, None),
    years_column: str = "WorkExpNum",
    keep_unknown_years: bool = True,
) -> DataFrame:
    """Rows in the chosen categories and years.  An empty list does not filter,
    bounds are inclusive, and an open bound is None."""
    rows = df
    for column, values in (members or {}).items():
        if values:
            rows = rows.where(named(column).isin(*values))
    low, high = years
    inside = F.lit(True)
    if low is not None:
        inside = inside & (named(years_column) >= low)
    if high is not None:
        inside = inside & (named(years_column) <= high)
    if not keep_unknown_years:
        return rows.where(named(years_column).isNotNull() & inside)
    if low is None and high is None:
        return rows
    return rows.where(named(years_column).isNull() | inside)


def ensemble_mean(columns: Sequence[str]) -> Column:
    """Row-wise mean of member columns."""
    total = F.lit(0.0)
    for column in columns:
        total = total + named(column)
    return total / F.lit(float(len(columns)))
