"""Median-split quadrants, labels and densities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorelab import vocabulary as V
from scorelab.functions.banding import fixed_bin, quadrant_label
from scorelab.functions.encode import named
from scorelab.operators.ranking import median_cuts


def one_row(scalars: DataFrame) -> Column:
    """A one-row frame as a struct inside another plan: a scalar subquery, so no
    join and no value passing through the client."""
    return scalars.select(F.struct(*[named(c) for c in scalars.columns])).scalar()


def analysed(scored: DataFrame) -> DataFrame:
    """Rows whose trust composite is known."""
    return scored.where(F.col("TrustScore").isNotNull())


def score_cuts(scored: DataFrame, exact: bool = True) -> DataFrame:
    """Median usage and trust of the analysed rows.

    Scores are means of small whole numbers: at most 6*6*11*21 usage and 13 trust
    values exist whatever the number of rows, so ranking all of them is cheap.
    """
    method = "few_values" if exact else "sketch"
    return median_cuts(analysed(scored), ["UsageScore", "TrustScore"], method)


def add_quadrants(scored: DataFrame, cuts: DataFrame | None = None, exact: bool = True) -> DataFrame:
    """Analysed rows plus their usage/trust quadrant."""
    cut = one_row(cuts if cuts is not None else score_cuts(scored, exact))
    return analysed(scored).withColumn(
        "TrustUsageGroup",
        quadrant_label("UsageScore", "TrustScore", cut.getField("UsageScore"), cut.getField("TrustScore")),
    )


def add_label(scored: DataFrame, cuts: DataFrame | None = None, exact: bool = True) -> DataFrame:
    """Analysed rows plus 1 for high usage with low trust, else 0."""
    cut = one_row(cuts if cuts is not None else score_cuts(scored, exact))
    focus = (F.col("UsageScore") >= cut.getField("UsageScore")) & (
        F.col("TrustScore") < cut.getField("TrustScore")
    )
    return analysed(scored).withColumn(V.LABEL, F.when(focus, F.lit(1)).otherwise(F.lit(0)))


def density(df: DataFrame, x: str, y: str, names: Sequence[str] = ("u_bin", "t_bin"), count: str = "Developers",
            width: int = 10, upper: int = 100) -> DataFrame:
    """Sparse two-dimensional histogram: only pairs of bins that occur."""
    return (
        df.dropna(subset=[x, y])
        .groupBy(fixed_bin(x, width, upper).alias(names[0]), fixed_bin(y, width, upper).alias(names[1]))
        .agg(F.count(F.lit(1)).alias(count))
    )


def dense_grid(sparse: DataFrame, names: Sequence[str] = ("u_bin", "t_bin"), count: str = "Developers",
               width: int = 10, upper: int = 100) -> DataFrame:
    """Every pair of bins, 0 where the sparse histogram has none."""
    side = upper // width
    cells = sparse.sparkSession.range(0, side * side, 1, 1).select(
        ((F.col("id") / side).cast("long") * width).alias(names[0]),
        ((F.col("id") % side) * width).alias(names[1]),
    )
    # The histogram has at most side*side rows.
    return cells.join(F.broadcast(sparse), list(names), "left").select(
        *names, F.coalesce(F.col(count), F.lit(0).cast("long")).alias(count)
    )
