"""Exact-size samples and splits that never gather the table in one task.

Rows are ordered by a seeded hash of their key, so taking the first m rows of
that order is a uniform, repeatable sample.  The m-th hash is found from counts
per hash prefix plus a ranking inside the single prefix it falls in (about one
row in a million); membership is then a comparison per row, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorelab.functions.encode import named
from scorelab.functions.hashing import hash_bucket, hash_key

ABOVE_ALL = "g"  # sorts after every hex digit


def _prefix_totals(hashed: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Rows per hash prefix with the running total up to and including it."""
    counts = hashed.groupBy(*groups, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    return counts.withColumn("_upto", F.sum("_n").over(upto))  # at most 16**5 rows per group


def _hashed(df: DataFrame, key: str, seed: int, groups: Sequence[Column] = ()) -> DataFrame:
    hashed = hash_key(key, seed)
    return df.select(*groups, hashed.alias("_hash"), hash_bucket(hashed).alias("_bucket"))


def bounded_sample(df: DataFrame, key: str, cap: int, seed: int = 0) -> DataFrame:
    """All rows when there are at most ``cap``, otherwise exactly ``cap`` of them.
    ``key`` must be unique."""
    hashed = _hashed(df, key, seed)
    edge = _prefix_totals(hashed, []).where((F.col("_upto") >= cap) & (F.col("_upto") - F.col("_n") < cap))
    # One row: the prefix that holds the cap-th hash.
    inside = hashed.join(
        F.broadcast(edge.select("_bucket", (F.lit(cap) - F.col("_upto") + F.col("_n")).alias("_need"))), "_bucket"
    )
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy("_hash"))
    cut = inside.withColumn("_place", place).where(F.col("_place") == F.col("_need")).agg(F.max("_hash")).scalar()
    return df.where(hash_key(key, seed) <= F.coalesce(cut, F.lit(ABOVE_ALL)))


def test_quotas(totals: DataFrame, label: str, count: str, fraction: str) -> DataFrame:
    """Test rows per class: ceil(fraction * n) in all, shared by largest remainder.

    Whole-number arithmetic on decimals, so large tables neither overflow nor round.
    ``fraction`` is decimal text such as ``"0.2"``.
    """
    everyone = Window.partitionBy()  # one row per class
    exact = f"CAST({count} AS DECIMAL(19,0))"
    sized = totals.withColumn("_all", F.sum(count).over(everyone)).withColumn(
        "_test", F.expr(f"CAST(CEIL(CAST(_all AS DECIMAL(19,0)) * CAST('{fraction}' AS DECIMAL(10,9))) AS BIGINT)")
    )
    shared = sized.withColumns(
        {
            "_floor": F.expr(f"({exact} * CAST(_test AS DECIMAL(19,0))) div CAST(_all AS DECIMAL(19,0))"),
            "_rest": F.expr(f"({exact} * CAST(_test AS DECIMAL(19,0))) % CAST(_all AS DECIMAL(19,0))"),
        }
    )
    left_over = F.col("_test") - F.sum("_floor").over(everyone)
    turn = F.row_number().over(Window.orderBy(F.col("_rest").desc(), named(label)))
    take = F.col("_floor") + F.when(F.col("_turn") <= F.col("_left"), 1).otherwise(0)
    return shared.withColumns({"_left": left_over, "_turn": turn}).select(named(label), take.alias("_take"))


def mark_test_rows(df: DataFrame, label: str, key: str, fraction: str = "0.2", seed: int = 42,
                   name: str = "is_test") -> DataFrame:
    """Add a boolean that marks an exact, stratified test share.  ``key`` must be unique.

    Rows without a label are a class like any other.  Quotas and cuts have one row
    per class and are joined by class; Spark broadcasts them where they are small.
    """
    hashed = _hashed(df, key, seed, [named(label).alias("_class")])
    prefixes = _prefix_totals(hashed, ["_class"])
    quotas = test_quotas(prefixes.groupBy("_class").agg(F.sum("_n").alias("_n")), "_class", "_n", fraction)

    def matched(left: DataFrame, right: DataFrame, how: str = "inner", more: Sequence[str] = ()) -> DataFrame:
        other = right.withColumnsRenamed({c: f"_{c}" for c in ["_class", *more]})
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ["_class", *more]]
        return left.join(other, same, how).drop(*[f"_{c}" for c in ["_class", *more]])

    edge = matched(prefixes, quotas).where(
        (F.col("_upto") >= F.col("_take")) & (F.col("_upto") - F.col("_n") < F.col("_take"))
    ).select("_class", "_bucket", (F.col("_take") - F.col("_upto") + F.col("_n")).alias("_need"))
    inside = matched(hashed, edge, more=["_bucket"])
    place = F.row_number().over(Window.partitionBy("_class", "_bucket").orderBy("_hash"))
    cuts = inside.withColumn("_place", place).where(F.col("_place") == F.col("_need")).select("_class", F.col("_hash").alias("_cut"))
    # A class without a quota has no cut, and none of its rows is a test row.
    marked = matched(df.withColumn("_class", named(label)), cuts, "left")
    return marked.withColumn(name, F.coalesce(hash_key(key, seed) <= F.col("_cut"), F.lit(False))).select(
        *[named(c) for c in df.columns], name
    )


def stratified_split(df: DataFrame, label: str, key: str, fraction: str = "0.2", seed: int = 42
                     ) -> tuple[DataFrame, DataFrame]:
    """(train, test): disjoint, complete and the same on every run."""
    marked = mark_test_rows(df, label, key, fraction, seed, "_is_test")
    return marked.where(~F.col("_is_test")).drop("_is_test"), marked.where("_is_test").drop("_is_test")
