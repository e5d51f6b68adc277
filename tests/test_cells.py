"""Slices rolled up from cells against the same slices of rows."""

import random

import pytest

from scorelab import vocabulary as V
from scorelab.operators.cells import add_cells, build_cells, slice_totals
from scorelab.plans import views

SCHEMA = "DevType string, Country string, WorkExpNum double, TrustUsageGroup string, UsageScore double, TrustScore double, FrustrationScore double"
GROUPS = [V.FOCUS_QUADRANT, "other", None]
def close(made, expected):
    a, b = ([tuple(r) for r in df.collect()] for df in (made, expected))
    assert len(a) == len(b)
    for x, y in zip(sorted(a, key=lambda r: str(r[:2])), sorted(b, key=lambda r: str(r[:2]))):
        assert x == pytest.approx(y) if all(isinstance(v, (int, float)) for v in x) else list(map(str, x)) == list(map(str, y))


def test_cells_give_what_rows_give(spark):
    draw = random.Random(3)
    score = [None, 0.0, 12.5, 50.0, 100.0]
    rows = [(draw.choice(["r1", "r2", None]), draw.choice(["c1", "c2", None]), draw.choice([None, 1.0, 7.0, 40.0]), draw.choice(GROUPS), *draw.choices(score, k=3)) for _ in range(200)]
    df = spark.createDataFrame(rows, SCHEMA)
    cells = add_cells(*(build_cells(spark.createDataFrame(part, SCHEMA)) for part in (rows[:90], rows[90:]))).cache()
    for how in ({"roles": ["r1"], "countries": ["c1", "c2"], "years": (2, None)}, {"years": (None, 7.0), "keep_unknown_years": False}):
        kept, rolled = views.slice_of(df, **how), views.slice_of(cells, **how)
        close(slice_totals(rolled), views.slice_kpis(kept))
        close(views.cell_quadrants(rolled), views.slice_quadrants(kept))
        close(views.cell_top_groups(rolled, "Country"), views.slice_top_groups(kept, "Country"))


def test_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    close(slice_totals(build_cells(df)), views.slice_kpis(df))
