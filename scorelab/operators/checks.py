"""Data-quality checks: one row each (name, passed, detail), joined into a report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorelab.functions.encode import named
from scorelab.operators.profiles import extreme_rows, spread
from scorelab.sources.tables import read_optional_table
from scorelab.sources.versions import Facts

COLUMNS = ["name", "passed", "detail"]


def _row(df: DataFrame, name: str, passed: Column, detail: Column) -> DataFrame:
    return df.select(F.lit(name).alias("name"), F.coalesce(passed, F.lit(False)).alias("passed"), detail.alias("detail"))


def _plain(spark: SparkSession, name: str, passed: bool, detail: str) -> DataFrame:
    return spark.range(1).select(
        F.lit(name).alias("name"), F.lit(passed).alias("passed"), F.lit(detail).alias("detail")
    )


def row_count_between(df: DataFrame, low: int, high: int, name: str = "row count") -> DataFrame:
    """Strictly inside the range."""
    n = F.col("n")
    return _row(df.agg(F.count(F.lit(1)).alias("n")), name, (n > low) & (n < high), F.concat(F.lit("rows="), n))


def has_columns(tables: Mapping[str, DataFrame], required: Mapping[str, Sequence[str]],
                name: str = "required columns") -> DataFrame:
    """Schema difference only; no data is read."""
    gaps = {t: sorted(set(cols) - set(tables[t].columns)) for t, cols in required.items()}
    gaps = {t: cols for t, cols in gaps.items() if cols}
    detail = "missing: " + ("; ".join(f"{t}: {', '.join(c)}" for t, c in sorted(gaps.items())) or "none")
    return _plain(next(iter(tables.values())).sparkSession, name, not gaps, detail)


def within_bounds(tables: Sequence[tuple[DataFrame, Sequence[str]]], low: float = 0.0, high: float = 100.0,
                  name: str = "score bounds") -> DataFrame:
    """Every non-null value of the given columns lies in [low, high].

    Each table is reduced to one row before the union.
    """
    parts = []
    for df, columns in tables:
        values = F.array(*[named(c).cast("double") for c in columns])
        parts.append(
            df.select(F.array_min(values).alias("lo"), F.array_max(values).alias("hi")).agg(
                F.min("lo").alias("lo"), F.max("hi").alias("hi")
            )
        )
    ends = reduce(DataFrame.unionByName, parts).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    detail = F.format_string("min=%.1f, max=%.1f", F.col("lo"), F.col("hi"))
    return _row(ends, name, (F.col("lo") >= low) & (F.col("hi") <= high), detail)


def extremes_are(df: DataFrame, key: str, value: str, highest: str, lowest: str,
                 name: str = "group ordering") -> DataFrame:
    ends = extreme_rows(df, key, value)
    passed = (F.col("HighestKey") == highest) & (F.col("LowestKey") == lowest)
    detail = F.format_string("highest=%.1f %s; lowest=%.1f %s", F.col("HighestValue"), F.col("HighestKey"),
                             F.col("LowestValue"), F.col("LowestKey"))
    return _row(ends, name, passed, detail)


def spread_below(df: DataFrame, key: str, value: str, excluding: str, limit: float,
                 name: str = "group spread") -> DataFrame:
    rng = spread(df, value, key, excluding, "range")
    return _row(rng, name, F.col("range") < limit, F.format_string("range=%.2f", F.col("range")))


def outputs_exist(spark: SparkSession, paths: Sequence[str], name: str = "output artefacts",
                  kind: str = "parquet") -> DataFrame:
    """Each expected result (``parquet``, ``csv`` or ``json``) is there and has a row."""
    gone = []
    for path in paths:
        table = read_optional_table(spark, path, kind)
        if table is None or table.isEmpty():
            gone.append(path)
    return _plain(spark, name, not gone, "missing: " + (", ".join(gone) or "none"))


# --- from the facts of written tables: no table is read ----------------------

def written_rows_between(spark: SparkSession, facts: Facts, low: int, high: int, name: str = "row count") -> DataFrame:
    """``row_count_between`` of a written table."""
    return _plain(spark, name, low < facts.rows < high, f"rows={facts.rows}")


def written_columns(spark: SparkSession, tables: Mapping[str, Facts], required: Mapping[str, Sequence[str]],
                    name: str = "required columns") -> DataFrame:
    """``has_columns`` of written tables."""
    gaps = {t: sorted(set(cols) - set(tables[t].columns)) for t, cols in sorted(required.items())}
    detail = "; ".join(f"{t}: {', '.join(c)}" for t, c in gaps.items() if c) or "none"
    return _plain(spark, name, detail == "none", f"missing: {detail}")


def written_within_bounds(spark: SparkSession, tables: Sequence[Facts], low: float = 0.0, high: float = 100.0,
                          name: str = "score bounds") -> DataFrame:
    """``within_bounds`` over all observed ranges of written tables; without any value it does not pass."""
    lows, highs = [v for t in tables for v in t.low.values()], [v for t in tables for v in t.high.values()]
    if not lows:
        return _plain(spark, name, False, "min=null, max=null")
    return _plain(spark, name, min(lows) >= low and max(highs) <= high, f"min={min(lows):.1f}, max={max(highs):.1f}")


def written_outputs(spark: SparkSession, tables: Mapping[str, Facts | None], name: str = "output artefacts") -> DataFrame:
    """``outputs_exist`` of written tables: each has a version with a row."""
    gone = [path for path, facts in tables.items() if facts is None or not facts.rows]
    return _plain(spark, name, not gone, "missing: " + (", ".join(gone) or "none"))


def quality_report(checks: Sequence[DataFrame], overall: str = "ALL") -> DataFrame:
    """All check rows plus one that says whether all passed."""
    rows = reduce(DataFrame.unionByName, checks)
    total = rows.agg(F.bool_and("passed").alias("passed"), F.count_if("passed").alias("ok"), F.count(F.lit(1)).alias("n"))
    return rows.unionByName(
        total.select(F.lit(overall).alias("name"), "passed", F.format_string("%d of %d passed", "ok", "n").alias("detail"))
    )
