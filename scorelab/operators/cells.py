"""Additive cells: a stored table of counts and sums from which any slice rolls up.

A slice by categories and years, its totals, means and top groups need nothing of a row beyond
its cell, so an interactive filter reads the cells (categories times years, whatever the
number of rows) and never the rows again.  Cells of new rows are added to the old ones.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorelab import vocabulary as V
from scorelab.functions.encode import named
from scorelab.operators.profiles import COUNT

DIMENSIONS = ("DevType", "Country", "WorkExpNum", "TrustUsageGroup")
MEASURES = ("UsageScore", "TrustScore", "FrustrationScore")
ROWS = "Rows"


def _sum(measure: str) -> str:
    return f"{measure}Sum"


def _known(measure: str) -> str:
    return f"{measure}Known"


def build_cells(rows: DataFrame, dimensions: Sequence[str] = DIMENSIONS, measures: Sequence[str] = MEASURES) -> DataFrame:
    """One row per combination of the dimensions, null being a value: rows, and sum and count of each measure.

    A partial and a final aggregate; a combination with a third of the rows is one row per task
    before the shuffle.
    """
    parts = [(F.sum(named(m).cast("double")).alias(_sum(m)), F.count(named(m)).alias(_known(m))) for m in measures]
    return rows.groupBy(*map(named, dimensions)).agg(F.count(F.lit(1)).alias(ROWS), *[c for pair in parts for c in pair])


def add_cells(*tables: DataFrame) -> DataFrame:
    """The cells of all rows behind several cell tables of the same dimensions and measures."""
    first, *rest = tables
    union = first
    for table in rest:
        union = union.unionByName(table)
    sums = [c for c in first.columns if c == ROWS or c.endswith(("Sum", "Known"))]
    return union.groupBy(*[named(c) for c in first.columns if c not in sums]).agg(*[F.sum(named(c)).alias(c) for c in sums])


def rows_in(where: Column | None = None) -> Column:
    """Number of rows behind the cells of a group, or behind those that meet a condition; 0 if none."""
    own = named(ROWS) if where is None else F.when(where, named(ROWS))
    return F.coalesce(F.sum(own), F.lit(0))


def mean_of(measure: str) -> Column:
    """Mean over the rows that have the measure; null if none has."""
    return F.try_divide(F.sum(named(_sum(measure))), F.sum(named(_known(measure))))


def roll_up(cells: DataFrame, keys: Sequence[str], means: Mapping[str, str], count: str = COUNT) -> DataFrame:
    """Group size and means by some of the dimensions, as ``profile`` gives from rows."""
    grouped = cells.groupBy(*map(named, keys))
    return grouped.agg(rows_in().alias(count), *[mean_of(m).alias(name) for name, m in means.items()])


def slice_totals(cells: DataFrame, quadrant: str = V.FOCUS_QUADRANT) -> DataFrame:
    """The one row of ``views.slice_kpis``."""
    inside, total = rows_in(where=F.col("TrustUsageGroup") == quadrant), rows_in()
    return cells.agg(total.alias("Developers"), inside.alias("FocusDevelopers"), F.try_divide(inside * 100.0, total).alias("FocusShare"),
                     *[mean_of(m).alias(f"Avg{m}") for m in MEASURES])
