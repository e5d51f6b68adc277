"""Turn answer texts into numbers and labels."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def named(column: str) -> Column:
    """Column by exact name, also when it holds spaces, dots or quotes."""
    return F.col("`" + column.replace("`", "``") + "`")


def as_column(column: Column | str) -> Column:
    return named(column) if isinstance(column, str) else column


def ordinal(column: Column | str, points: Mapping[str, int | float], default) -> Column:
    """Points for an exact answer text; ``default`` (0 or None) must be stated."""
    source = as_column(column)
    kind = "double" if any(isinstance(v, float) for v in points.values()) else "int"
    chain = F.when(F.lit(False), F.lit(default))
    for text, value in points.items():
        chain = chain.when(source == F.lit(text), F.lit(value))
    return chain.otherwise(F.lit(default)).cast(kind)


def multiselect_count(
    column: Column | str,
    separator: str = ";",
    exclude: Sequence[str] | None = None,
    empty_values: Sequence[str] = (),
) -> Column:
    """Number of tokens in a joined answer; null counts as 0.

    Without ``exclude`` every token counts, repeated and empty ones too, so the
    count is the number of separators plus one and no array is built.  With
    ``exclude`` the distinct tokens outside that list are counted.
    """
    source = as_column(column)
    if exclude is None:
        bare = F.replace(source, F.lit(separator), F.lit(""))
        tokens = (F.length(source) - F.length(bare)) / F.lit(len(separator)) + F.lit(1)
    else:
        stop = F.array(*[F.lit(text) for text in exclude])
        pieces = F.split(source, re.escape(separator))
        tokens = F.size(F.array_except(pieces, stop))
    missing = source.isNull()
    if empty_values:
        missing = missing | source.isin(*empty_values)
    return F.when(missing, F.lit(0)).otherwise(tokens.cast("int"))


def capped(column: Column | str, ceiling: int | float) -> Column:
    return F.least(as_column(column), F.lit(ceiling))


def weighted_sum_capped(full: Column | str, partial: Column | str, weight: float, ceiling: float) -> Column:
    """``full`` counts whole, ``partial`` at ``weight``; the sum stops at ``ceiling``."""
    return F.least(as_column(full) + as_column(partial) * F.lit(weight), F.lit(ceiling))


def parse_number(column: Column | str, phrases: Mapping[str, float] | None = None) -> Column:
    """Text to double; known phrases first, anything malformed becomes null."""
    source = as_column(column)
    number = source.try_cast("double")
    for text, value in reversed(list((phrases or {}).items())):
        number = F.when(source == F.lit(text), F.lit(float(value))).otherwise(number)
    return number


def _literal_map(labels: Mapping) -> Column:
    return F.create_map(*[F.lit(part) for pair in labels.items() for part in pair])


def lookup(column: Column | str, labels: Mapping, otherwise: Column | str | int | None = None) -> Column:
    """Relabel by dictionary.  Unmatched values keep their text, or take ``otherwise``."""
    source = as_column(column)
    fallback = source if otherwise is None else otherwise
    if not isinstance(fallback, Column):
        fallback = F.lit(fallback)
    return F.coalesce(F.try_element_at(_literal_map(labels), source), fallback)


def ranked(column: Column | str, order: Sequence[str], missing: int = 99) -> Column:
    """Position of a category in a declared order; unlisted categories come last."""
    return lookup(column, {text: i for i, text in enumerate(order)}, otherwise=missing)


def all_present(columns: Sequence[Column | str]) -> Column:
    return reduce(lambda a, b: a & b, [as_column(c).isNotNull() for c in columns])
