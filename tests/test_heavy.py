"""Heavy hitters against plain counts: lossless, proven by the bound, and not provable."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from scorelab.operators import heavy
from scorelab.operators.heavy import frequency_summary, heavy_hitters


def expected(values, k):
    order = sorted(Counter(values).items(), key=lambda x: (-x[1], x[0] is not None, x[0] or 0))
    return order[:k]


def skewed(n, seed):
    draw = random.Random(seed)
    return [None if draw.random() < 0.1 else int(draw.paretovariate(0.9)) if draw.random() < 0.6 else draw.randint(1000, 10**6) for _ in range(n)]


@pytest.mark.parametrize("counters, whole", [(10**6, False), (400, False), (3, True)])
def test_counts_are_exact(spark, monkeypatch, counters, whole):
    values = skewed(20_000, counters)
    df = spark.createDataFrame([(v, "x") for v in values], "own long, value string").repartition(5)
    passes = []
    monkeypatch.setattr(heavy, "frequencies", lambda d, *a: passes.append(d) or real(d, *a))
    found = [tuple(r) for r in heavy_hitters(df, "own", 8, counters, "n").collect()]
    assert found == expected(values, 8)
    # Nothing lost: no second pass; bound holds: a pass over candidates; otherwise all values.
    assert len(passes) == (counters < 10**6) and all((p is df) == whole for p in passes)


real = heavy.frequencies


def test_summaries_bound_counts_and_merge(spark):
    values = skewed(15_000, 1)
    df = spark.createDataFrame([(v,) for v in values], "v long")
    parts = [frequency_summary(df.where(F.col("v") % 2 == i), "v", 200) for i in (0, 1)]
    rows = parts[0].unionAll(parts[1]).unionAll(frequency_summary(df.where("v IS NULL"), "v", 200)).collect()
    lost, sums = sum(r.lost for r in rows), Counter()
    for r in rows:
        sums[r.value] += r.n
    assert 0 < lost <= len(values) / 201
    assert all(sums[v] <= n <= sums[v] + lost for v, n in Counter(values).items())


def test_ties_strings_and_empty_tables(spark):
    df = spark.createDataFrame([(c,) for c in "bbaaccd"], "Value string")
    assert [tuple(r) for r in heavy_hitters(df, "Value", 2, count="n").collect()] == [("a", 2), ("b", 2)]
    assert [tuple(r) for r in heavy_hitters(df, "Value", 2, counters=1, count="n").collect()] == [("a", 2), ("b", 2)]
    assert heavy_hitters(df.limit(0), "Value", 2).collect() == []
    nulls = spark.createDataFrame([(None,)] * 3, "Value string")
    assert [tuple(r) for r in heavy_hitters(nulls, "Value", 2, count="n").collect()] == [(None, 3)]
