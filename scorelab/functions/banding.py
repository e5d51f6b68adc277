"""Cut numeric columns into labelled pieces."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from scorelab import vocabulary as V
from scorelab.functions.encode import as_column


def band(
    column: Column | str,
    edges: Sequence[float],
    labels: Sequence[str],
    null_label: str | None = None,
    null_in_last: bool = False,
) -> Column:
    """Half-open bands ``[lower, upper)``; one more label than edges.

    A null value gets ``null_label``.  ``null_in_last`` instead lets it fall
    through to the last band, as an ELSE branch does.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("need one more label than edges")
    source = as_column(column)
    never = F.when(F.lit(False), F.lit(None).cast("string"))
    chain = never if null_in_last else F.when(source.isNull(), F.lit(null_label))
    for edge, label in zip(edges, labels):
        chain = chain.when(source < F.lit(edge), F.lit(label))
    return chain.otherwise(F.lit(labels[-1]))


def experience_group(years: Column | str) -> Column:
    """Career stage from years.  The middle ranges are closed whole-year ranges,
    so a fraction between two of them (5.5, 10.5) lands in the last group."""
    source = as_column(years)
    beginner, junior, middle, senior, expert, unknown = V.EXPERIENCE_GROUPS
    return (
        F.when(source.isNull(), F.lit(unknown))
        .when(source < 2, F.lit(beginner))
        .when(source.between(2, 5), F.lit(junior))
        .when(source.between(6, 10), F.lit(middle))
        .when(source.between(11, 20), F.lit(senior))
        .otherwise(F.lit(expert))
    )


def quadrant_label(x: Column | str, y: Column | str, x_cut: Column, y_cut: Column) -> Column:
    """Two-axis label; a value equal to its cut counts as high."""
    low_low, low_high, high_low, high_high = V.QUADRANTS
    x_high, y_high = as_column(x) >= x_cut, as_column(y) >= y_cut
    return (
        F.when(x_high & y_high, F.lit(high_high))
        .when(x_high, F.lit(high_low))
        .when(y_high, F.lit(low_high))
        .otherwise(F.lit(low_low))
    )


def fixed_bin(column: Column | str, width: int = 10, upper: int = 100) -> Column:
    """Lower edge of a fixed-width bin; ``upper`` itself joins the last bin."""
    last = upper // width - 1
    return F.least(F.floor(as_column(column) / F.lit(width)), F.lit(last).cast("long")) * F.lit(width).cast("long")
