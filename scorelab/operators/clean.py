"""De-duplication, null handling and numeric parsing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorelab import vocabulary as V
from scorelab.functions.encode import named, parse_number
from scorelab.sources.tables import select_available


def dedupe_by_key(df: DataFrame, keys: Sequence[str], deterministic: bool = False) -> DataFrame:
    """One row per key.

    By default any copy may survive.  ``deterministic`` keeps the smallest row in
    column order.  Both forms are aggregates with a map-side part, so a key that
    holds most of the table is reduced before the shuffle; a ranking window would
    send all its copies to one task.
    """
    if not deterministic:
        return df.dropDuplicates(list(keys))
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    smallest = df.groupBy(*[named(k) for k in keys]).agg(
        F.min(F.struct(*[named(c) for c in rest])).alias("_row")
    )
    return smallest.select(
        *[named(c) if c in keys else F.col("_row").getField(c).alias(c) for c in df.columns]
    )


def fill_defaults(df: DataFrame, defaults: Mapping[str, object] = V.FILL_DEFAULTS) -> DataFrame:
    """Replace nulls by a default per column; columns not present are skipped."""
    return df.withColumns(
        {c: F.coalesce(named(c), F.lit(v)) for c, v in defaults.items() if c in df.columns}
    )


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null or NaN in any (or the given) columns."""
    return df.dropna(subset=list(columns)) if columns else df.dropna()


def parse_experience(df: DataFrame) -> DataFrame:
    """Numeric companions of the two years-of-experience answers."""
    return df.withColumns(
        {
            "WorkExpNum": parse_number("WorkExp"),
            "YearsCodeNum": parse_number("YearsCode", V.YEARS_EDGE_PHRASES),
        }
    )


def clean_responses(df: DataFrame, deduplicate: bool = True) -> DataFrame:
    """Raw all-text responses to the cleaned table.

    ``deduplicate=False`` skips the only shuffle, for inputs whose key is known
    to be unique.
    """
    kept, _ = select_available(df, V.SURVEY_COLUMNS)
    if deduplicate:
        kept = dedupe_by_key(kept, [V.KEY])
    return parse_experience(fill_defaults(kept))
