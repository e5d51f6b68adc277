"""Column functions against hand-computed rows."""

import pytest
from pyspark.sql import functions as F

from scorelab import functions as fn
from scorelab import vocabulary as V
from scorelab.functions.banding import band
from scorelab.operators import scores as S


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column.alias("x")).collect()]


@pytest.mark.parametrize(
    "text, all_tokens, distinct",
    [(None, 0, 0), ("", 1, 1), ("a", 1, 1), ("a;a;b", 3, 2), ("stop;a;a", 3, 1), ("stop", 1, 0), ("a;", 2, 2),
     ("none given", 1, 0)],
)
def test_multiselect(spark, text, all_tokens, distinct):
    total = fn.multiselect_count("t")
    kept = fn.multiselect_count("t", exclude=["stop"], empty_values=["none given"])
    row = spark.createDataFrame([(text,)], "t string").select(total.alias("a"), kept.alias("b")).first()
    assert (row.a, row.b) == (all_tokens, distinct)


def test_multiselect_takes_separator_literally(spark):
    assert values(spark, [("a||b||c",)], "t string", fn.multiselect_count("t", "||")) == [3]
    assert values(spark, [("a||b||b",)], "t string", fn.multiselect_count("t", "||", exclude=["a"])) == [1]


def test_stop_list_needs_the_typographic_apostrophe(spark):
    rows = [("I haven’t encountered any problems",), ("I haven't encountered any problems",)]
    assert values(spark, rows, "t string", fn.multiselect_count("t", exclude=V.NOT_A_PROBLEM)) == [0, 1]


def test_ordinal_is_exact_and_its_default_matters(spark):
    rows = [("Very favorable",), ("very favorable",), (" Favorable",), ("Unsure",), (None,)]
    assert values(spark, rows, "t string", fn.ordinal("t", V.SENTIMENT_POINTS, None)) == [5, None, None, None, None]
    assert values(spark, rows, "t string", fn.ordinal("t", V.SENTIMENT_POINTS, 0)) == [5, 0, 0, 0, 0]


def test_parse_number(spark):
    rows = [("3",), ("2.5",), ("x",), ("",), (None,), ("Less than 1 year",), ("More than 50 years",)]
    assert values(spark, rows, "t string", fn.parse_number("t")) == [3.0, 2.5, None, None, None, None, None]
    assert values(spark, rows, "t string", fn.parse_number("t", V.YEARS_EDGE_PHRASES)) == [
        3.0, 2.5, None, None, None, 0.0, 51.0]


def test_names_with_quotes_and_spaces(spark):
    df = spark.createDataFrame([("a;b",)], "`it's a ``name``` string")
    assert df.select(fn.multiselect_count("it's a `name`")).first()[0] == 2


def test_bands(spark):
    rows = [(0.0,), (24.999,), (25.0,), (50.0,), (75.0,), (100.0,), (None,)]
    low, mid, upper, high = V.USAGE_BANDS
    known = [low, low, mid, upper, high, high]
    assert values(spark, rows, "v double", band("v", V.USAGE_BAND_EDGES, V.USAGE_BANDS, "?")) == known + ["?"]
    assert values(spark, rows, "v double", band("v", V.USAGE_BAND_EDGES, V.USAGE_BANDS, null_in_last=True)) == known + [high]
    with pytest.raises(ValueError):
        band("v", [1], ["only one"])


def test_experience_groups_keep_their_gaps(spark):
    rows = [(None,), (0.0,), (1.9,), (2.0,), (5.0,), (5.5,), (6.0,), (10.0,), (10.5,), (20.0,), (20.5,), (50.0,)]
    b, j, m, s, e, u = V.EXPERIENCE_GROUPS
    assert values(spark, rows, "v double", fn.experience_group("v")) == [u, b, b, j, j, e, m, m, e, s, e, e]


def test_fixed_bin(spark):
    rows = [(0.0,), (9.99,), (10.0,), (89.9,), (90.0,), (100.0,), (None,)]
    assert values(spark, rows, "v double", fn.fixed_bin("v"))[:-1] == [0, 0, 10, 80, 90, 90]


def test_labels(spark):
    rows = [("Developer, game or graphics",), ("Developer, web or mobile",), ("Data engineer",)]
    assert values(spark, rows, "v string", fn.shorten_role("v")) == [
        "Game/graphics developer", "web / mobile", "Data engineer"]
    assert values(spark, rows, "v string", fn.lookup("v", {"Data engineer": "D"}, otherwise="Other")) == ["Other", "Other", "D"]
    assert values(spark, rows, "v string", fn.ranked("v", ["Data engineer"])) == [99, 99, 0]


def test_display(spark):
    df = spark.createDataFrame([(1234567, 31.25)], "n long, v double")
    row = df.select(fn.thousands_text("n"), fn.fixed_text("v"), fn.percent_text("v", 2), fn.bin_label(F.lit(10))).first()
    assert list(row) == ["1,234,567", "31.2", "31.25%", "10-20"]


def test_published_score_rows(spark):
    """Inputs and outputs of five published respondents."""
    rows = [
        (1, 1, 0, 0.0, 10.0, 1, 1, 2, 8.333333333333332, 2, 0.0, 20.0),
        (5, 3, 4, 2.5, 56.25, 3, 4, 5, 75.0, 3, 0.5, 55.00000000000001),
        (5, 0, 9, 5.0, 60.0, 2, 2, 3, 33.33333333333333, 1, 0.0, 10.0),
        (1, 0, 0, 0.0, 5.0, 1, 1, 1, 0.0, 2, 0.0, 20.0),
        (0, 0, 0, 0.0, 0.0, None, None, None, None, 0, 0.0, 0.0),
    ]
    schema = ("UsageFreq int, AgentDepth int, AIModelCountCapped int, WorkflowIntegration double, u double, "
              "TrustAcc int, TrustComplex int, Sentiment int, t double, ProblemCountCapped int, ThreatLevel double, f double")
    for row in S.add_scores(spark.createDataFrame(rows, schema)).collect():
        assert (row.UsageScore, row.TrustScore, row.FrustrationScore) == (row.u, row.t, row.f)


def test_strict_score_needs_every_component(spark):
    df = spark.createDataFrame([(5, None, 5)], "TrustAcc int, TrustComplex int, Sentiment int")
    assert df.select(S.composite(S.TRUST)).first()[0] is None
