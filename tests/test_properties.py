"""Properties that hold for any answers; each example is one small Spark job."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scorelab import functions as fn
from scorelab import vocabulary as V
from scorelab.functions.banding import band
from scorelab.operators import scores as S
from scorelab.operators import segments as G

FEW = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
TOKENS = st.lists(st.sampled_from(["a", "b", "", "stop"]), min_size=1, max_size=6).map(";".join)


def answer(vocabulary):
    return st.one_of(st.none(), st.just("other"), st.sampled_from(list(vocabulary)))


RESPONSE = st.tuples(
    answer(V.USAGE_POINTS), answer(V.AGENT_POINTS), answer(V.ACCURACY_POINTS), answer(V.COMPLEX_POINTS),
    answer(V.SENTIMENT_POINTS), answer(V.THREAT_POINTS), *[st.one_of(st.none(), TOKENS)] * 5,
)
COLUMNS = ["AISelect", "AIAgents", "AIAcc", "AIComplex", "AISent", "AIThreat", "AIModelsHaveWorkedWith",
           "AIToolCurrently mostly AI", "AIToolCurrently partially AI", "AIFrustration", "DevEnvsHaveWorkedWith"]


@FEW
@given(rows=st.lists(RESPONSE, min_size=1, max_size=40))
def test_scores_stay_in_range_and_trust_is_all_or_nothing(spark, rows):
    raw = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in COLUMNS))
    scored = S.score_responses(raw)
    parts = [F.col(c).isNotNull().cast("int") for c in ("TrustAcc", "TrustComplex", "Sentiment")]
    complete = (parts[0] + parts[1] + parts[2]) == 3
    wrong = (
        ~F.col("UsageScore").between(0, 100) | ~F.col("FrustrationScore").between(0, 100)
        | F.coalesce(~F.col("TrustScore").between(0, 100), F.lit(False)) | (F.col("TrustScore").isNotNull() != complete)
        | F.col("UsageScore").isNull() | F.col("FrustrationScore").isNull()
    )
    assert scored.where(wrong).count() == 0


@FEW
@given(texts=st.lists(st.one_of(st.none(), TOKENS), min_size=1, max_size=40))
def test_token_counts_equal_plain_splitting(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", fn.multiselect_count("t").alias("n"), fn.multiselect_count("t", exclude=["stop"]).alias("k"))
    for r in rows.collect():
        pieces = r.t.split(";") if r.t is not None else []
        assert (r.n, r.k) == (len(pieces), len(set(pieces) - {"stop"}))


@FEW
@given(pairs=st.lists(st.tuples(st.floats(0, 100), st.floats(0, 100)), min_size=1, max_size=60))
def test_bands_and_quadrants_follow_their_edges(spark, pairs):
    df = spark.createDataFrame(pairs, "UsageScore double, TrustScore double")
    cut = G.score_cuts(df).first()
    rows = G.add_quadrants(df).withColumn("band", band("UsageScore", V.USAGE_BAND_EDGES, V.USAGE_BANDS)).collect()
    assert len(rows) == len(pairs)
    for r in rows:
        usage = "High" if r.UsageScore >= cut.UsageScore else "Low"
        trust = "High" if r.TrustScore >= cut.TrustScore else "Low"
        assert r.TrustUsageGroup == f"{usage} Usage - {trust} Trust"
        assert r.band == V.USAGE_BANDS[sum(r.UsageScore >= e for e in V.USAGE_BAND_EDGES)]
    ordered = sorted(u for u, _ in pairs)
    assert cut.UsageScore == ordered[(len(ordered) + 1) // 2 - 1]
