"""Operators on small frames: edge cases, exactness, skew."""

import random

import pytest
from pyspark.sql import functions as F

from scorelab import vocabulary as V
from scorelab.operators import checks as X
from scorelab.operators import classify as C
from scorelab.operators import clean as N
from scorelab.operators import clustering as K
from scorelab.operators import metrics as M
from scorelab.operators import profiles as P
from scorelab.operators import ranking as R
from scorelab.operators import sampling as S
from scorelab.operators import segments as G
from scorelab.plans import models


def test_dedupe_keeps_one_row_per_key(spark):
    df = spark.createDataFrame([("a", 2, None), ("a", 1, "x"), ("b", 5, "y"), ("a", 1, "w")], "k string, n int, t string")
    kept = N.dedupe_by_key(df, ["k"], deterministic=True).orderBy("k").collect()
    assert [tuple(r) for r in kept] == [("a", 1, "w"), ("b", 5, "y")]
    assert N.dedupe_by_key(df, ["k"]).count() == 2
    assert N.dedupe_by_key(df.select("k"), ["k"], deterministic=True).count() == 2


def test_drop_incomplete_treats_nan_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "v double")
    assert N.drop_incomplete(df, ["v"]).count() == 1


@pytest.mark.parametrize("n", [1, 2, 3, 4, 101, 5000])
def test_medians_of_many_values(spark, n):
    rng = random.Random(n)
    rows = [(rng.random(), float(rng.randint(0, 3)) if rng.random() < 0.8 else None) for _ in range(n)]
    df = spark.createDataFrame(rows, "a double, b double")

    def lower_median(values):
        known = sorted(v for v in values if v is not None)
        return known[(len(known) + 1) // 2 - 1] if known else None

    wanted = (lower_median([r[0] for r in rows]), lower_median([r[1] for r in rows]))
    assert tuple(R.median_cuts(df, ["a", "b"], "sliced").first()) == wanted
    assert tuple(R.median_cuts(df, ["a", "b"], "few_values").first()) == wanted


def test_median_with_one_value_holding_most_rows(spark):
    df = spark.range(10000).select(F.when(F.col("id") < 7000, 5.0).otherwise(F.col("id").cast("double")).alias("v"))
    assert R.median_cuts(df, ["v"], "sliced").first()[0] == 5.0
    assert R.median_cuts(df, ["v"], "sketch").first()[0] == 5.0
    with pytest.raises(ValueError):
        R.median_cuts(df, ["v"], "guess")


def test_running_totals(spark):
    rng = random.Random(7)
    rows = [(g, float(v), rng.randint(1, 9)) for g in "ab" for v in rng.sample(range(10**6), 3000)]
    df = spark.createDataFrame(rows, "g string, v double, n long")
    found = {(r.g, r.v): (r.n_before, r.n_total) for r in R.running_totals(df, ["g"], "v", ["n"]).collect()}
    assert len(found) == len(rows)
    for group in "ab":
        total = sum(n for g, _, n in rows if g == group)
        before = 0
        for _, v, n in sorted(r for r in rows if r[0] == group):
            assert found[group, v] == (before, total)
            before += n


@pytest.mark.parametrize("cap", [1, 10, 999, 1000, 2000])
def test_bounded_sample_is_exact(spark, cap):
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"))
    first = {r.k for r in S.bounded_sample(df, "k", cap, 3).collect()}
    assert len(first) == min(cap, 1000)
    assert first == {r.k for r in S.bounded_sample(df.repartition(7), "k", cap, 3).collect()}
    if cap == 10:
        assert first != {r.k for r in S.bounded_sample(df, "k", cap, 4).collect()}


def test_split_is_exact_disjoint_and_complete(spark):
    df = spark.range(25314).select("id", (F.col("id") < 4067).cast("int").alias("y"))
    train, test = S.stratified_split(df, "y", "id")
    assert (train.count(), test.count()) == (20251, 5063)
    assert train.join(test, "id", "left_semi").count() == 0
    assert {r.y: r["count"] for r in test.groupBy("y").count().collect()} == {0: 4250, 1: 813}


def test_split_quotas_follow_the_largest_remainders(spark):
    df = spark.range(10).select("id", F.when(F.col("id") < 3, "a").when(F.col("id") < 6, "b").otherwise("c").alias("y"))
    _, test = S.stratified_split(df, "y", "id", "0.25")
    assert {r.y: r["count"] for r in test.groupBy("y").count().collect()} == {"a": 1, "b": 1, "c": 1}


def test_profile_counts_rows_and_means_skip_nulls(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 4.0)], "k string, v double")
    rows = P.profile(df, ["k"], {"m": "v"}, order=[F.col("m").desc()]).collect()
    assert [tuple(r) for r in rows] == [("b", 1, 4.0), ("a", 2, 1.0)]
    assert P.profile(df, ["k"], {"m": "v"}, min_count=2).count() == 1


def test_extremes_overlap_without_duplicates(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 3.0), ("d", None)], "k string, v double")
    assert [r.k for r in P.extremes(df, "k", "v", 2, 2).collect()] == ["a", "b", "c"]


def test_summary_of_nothing(spark):
    df = spark.createDataFrame([], "c string, v double")
    row = P.summary(df, {"kinds": "c"}, {"present": "v"}, {"mean": "v"}).first()
    assert tuple(row) == (0, 0, 0, None)


def test_slice_bounds_and_unknowns(spark):
    df = spark.createDataFrame([("x", 0.0), ("x", 50.0), ("y", 51.0), ("y", None)], "DevType string, WorkExpNum double")
    assert P.slice_rows(df).count() == 4
    assert P.slice_rows(df, {"DevType": []}, (0, 50)).count() == 3
    assert P.slice_rows(df, {"DevType": ["y"]}, (0, 50)).count() == 1
    assert P.slice_rows(df, {}, (0, 50), keep_unknown_years=False).count() == 2
    assert P.slice_rows(df, {}, (None, None), keep_unknown_years=False).count() == 3


def test_pivot_can_skip_absent_columns(spark):
    df = spark.createDataFrame([("r", "a", 2), ("s", "b", 3)], "k string, c string, n long")
    assert P.pivot_counts(df, "k", "c", "n", ["b", "z", "a"]).columns == ["k", "b", "z", "a"]
    narrow = P.pivot_counts(df, "k", "c", "n", ["b", "z", "a"], skip_absent=True).orderBy("k")
    assert [tuple(r) for r in narrow.collect()] == [("r", 0, 2), ("s", 3, 0)]


def test_dense_grid_has_every_cell(spark):
    df = spark.createDataFrame([(100.0, 0.0), (99.0, 5.0), (None, 1.0)], "x double, y double")
    grid = G.dense_grid(G.density(df, "x", "y")).collect()
    assert len(grid) == 100
    assert {(r.u_bin, r.t_bin): r.Developers for r in grid if r.Developers} == {(90, 0): 2}


def test_quadrants_put_the_cut_on_the_high_side(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, 1.0), (3.0, None)], "UsageScore double, TrustScore double")
    rows = {(r.UsageScore, r.TrustScore): r.TrustUsageGroup for r in G.add_quadrants(df).collect()}
    assert rows == {(1.0, 1.0): "Low Usage - High Trust", (2.0, 2.0): "High Usage - High Trust",
                    (3.0, 1.0): "High Usage - High Trust"}


def test_published_metrics(rated):
    row = M.binary_metrics(rated, "y", "guess").first()
    assert row.n == 5063
    for name, value in {"accuracy": 0.8364605965, "precision": 0.4807, "recall": 0.2300, "f1": 0.3112,
                        "balanced_accuracy": 0.5912, "baseline_accuracy": 0.8394}.items():
        assert row[name] == pytest.approx(value, abs=6e-5)
    report = {r["class"]: r for r in M.classification_report(rated, "y", "guess").collect()}
    assert report["1"].support == 813 and report["macro avg"].support == 5063
    assert report["weighted avg"].recall == pytest.approx(0.8364605965)


def test_undefined_ratios_are_zero(spark):
    row = M.binary_metrics(spark.createDataFrame([(0, 0)], "y int, p int"), "y", "p").first()
    assert (row.precision, row.recall, row.f1, row.balanced_accuracy) == (0.0, 0.0, 0.0, 1.0)


def test_auc_ties_transforms_and_flips(spark):
    rng = random.Random(1)
    rows = [(int(rng.random() < 0.3), float(rng.randint(0, 40))) for _ in range(2000)]
    pos = [s for y, s in rows if y]
    neg = [s for y, s in rows if not y]
    wanted = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    df = spark.createDataFrame(rows, "y int, s double")
    df = df.select("y", "s", F.exp("s").alias("grown"), (-F.col("s")).alias("flipped"))
    found = {r.score: r.roc_auc for r in M.roc_auc(df, "y", ["s", "grown", "flipped"]).collect()}
    assert found["s"] == pytest.approx(wanted)
    assert found["grown"] == pytest.approx(wanted)
    assert found["flipped"] == pytest.approx(1 - wanted)
    assert M.roc_auc(df.where("y = 1"), "y", "s").first().roc_auc is None


def test_quality_report(spark, small):
    df = spark.createDataFrame([("a", 10.0), ("b", 20.0)], "k string, v double")
    checks = [
        X.row_count_between(df, 2, 5, "rows"), X.has_columns({"t": df}, {"t": ["k", "v"]}),
        X.within_bounds([(df, ["v"])]), X.extremes_are(df, "k", "v", "b", "a"), X.spread_below(df, "k", "v", "a", 1.0),
        X.outputs_exist(spark, [f"{small}/orders.parquet", f"{small}/nothing.parquet"]),
    ]
    rows = {r.name: r for r in X.quality_report(checks).collect()}
    assert not rows["rows"].passed  # strictly inside
    assert rows["required columns"].passed and rows["score bounds"].passed and rows["group ordering"].passed
    assert rows["group spread"].passed and not rows["output artefacts"].passed
    assert (rows["ALL"].passed, rows["ALL"].detail) == (False, "4 of 6 passed")


def test_standardize(spark):
    df = spark.createDataFrame([(1.0, 7.0), (2.0, 7.0), (3.0, 7.0)], "a double, c double")
    rows = K.standardize(df, ["a", "c"]).orderBy("a").collect()
    assert [r.a_z for r in rows] == pytest.approx([-1.5**0.5, 0.0, 1.5**0.5])
    assert [r.c_z for r in rows] == [0.0, 0.0, 0.0]


def test_sampled_silhouette_against_pairs(spark):
    rng = random.Random(5)
    rows = [(i, i % 3, [rng.gauss(i % 3, 1.0), rng.gauss(0, 1.0)]) for i in range(90)] + [(90, 9, [5.0, 5.0])]
    total = 0.0
    for i, own, p in rows:
        means = {}
        for c in {r[1] for r in rows}:
            gaps = [((p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2) ** 0.5 for j, o, q in rows if o == c and j != i]
            means[c] = sum(gaps) / len(gaps) if gaps else None
        a, b = means[own], min(v for c, v in means.items() if c != own)
        total += 0.0 if a is None else (b - a) / max(a, b)
    df = spark.createDataFrame(rows, "id long, c int, x array<double>")
    assert K.silhouette_sampled(df, "c", "x", "id").first()[0] == pytest.approx(total / len(rows))
    assert K.silhouette_sampled(df, "c", "x", "id", cap=40).first()[0] is not None


def _planted(spark, n=600):
    return spark.range(n).select(
        F.col("id").cast("string").alias("id"), (F.rand(1) + F.when(F.col("id") % 2 == 0, 5).otherwise(0)).alias("a"),
        F.rand(2).alias("b"), (F.col("id") % 2).cast("int").alias("y"),
    )


def test_kmeans_finds_planted_groups_with_canonical_ids(spark):
    vectors = K.standardized_vectors(_planted(spark), ["a", "b"], ["id", "y"])
    marked = K.assign_clusters(vectors, K.best_kmeans(vectors, "id", [2], starts=2)[2])
    assert marked.groupBy("y").agg(F.countDistinct("Cluster").alias("n")).agg(F.max("n")).first()[0] == 1
    assert marked.where("y = 0 AND Cluster <> 0").count() == 0  # larger centre first
    scan = K.kmeans_scan(vectors, "id", (2, 3), starts=2).collect()
    assert [r.k for r in scan] == [2, 3] and scan[0].inertia >= scan[1].inertia
    assert K.kmeans_scan(vectors, "id", (2,), starts=1, sample_cap=None).first().silhouette > 0.5
    projected = K.project_2d(marked)
    assert projected.agg(F.abs(F.avg("PC1"))).first()[0] < 1e-9


def test_a_small_coreset_costs_about_what_all_rows_cost(spark):
    """Ten starts on 400 of 6,000 rows end within one percent of ten starts on all of them."""
    rows = spark.range(6000).select(
        F.col("id").cast("string").alias("id"), *[(F.randn(i) * 0.7 + (F.col("id") % 3 == i % 3).cast("int") * 3).alias(c) for i, c in enumerate("abc")])
    vectors = K.standardized_vectors(rows, ["a", "b", "c"], ["id"]).cache()
    sample = K.coreset(vectors, "id", 400, 7)
    weights = [r.weight for r in sample.select("weight").collect()]
    assert 300 < len(weights) < 520 and sum(weights) == pytest.approx(6000, rel=0.15) and min(weights) > 1
    assert K.coreset(vectors, "id", 20_000, 7).where("weight = 1").count() == 6000
    few, all_rows = K.best_kmeans(vectors, "id", [3], size=400)[3], K.best_kmeans(vectors, "id", [3], size=20_000)[3]
    assert few.cost == pytest.approx(all_rows.cost, rel=0.01)
    assert K.assign_clusters(vectors, few).groupBy("Cluster").count().count() == 3


def test_forest_votes_on_planted_signal(spark):
    train, test = S.stratified_split(_planted(spark), "y", "id")
    ensemble = C.fit_ensemble(train, ["a", "b"], "y", seeds=(1, 2), trees=5, depth=3)
    voted = C.vote(ensemble, test)
    assert voted.count() == 120
    assert voted.where("y_true = y_pred").count() == 120
    importance = C.feature_importance(ensemble, spark).collect()
    assert importance[0].Feature == "a" and sum(r.Importance for r in importance) == pytest.approx(1.0)


def test_forests_vote_in_a_session_that_observed_a_write(spark):
    from pyspark.sql import Observation

    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 3}
    forest = C.fit_ensemble(_planted(spark), ["a", "b"], "y", seeds=(1,), trees=3, depth=2)
    assert C.vote(forest, _planted(spark)).where("y_true = y_pred").count() > 0


def test_label_lineage_is_refused():
    with pytest.raises(ValueError, match="TrustScore"):
        C.check_leakage(["UsageFreq", "TrustScore"], models.label_lineage())


def test_split_with_many_classes_and_rows_without_a_label(spark):
    df = spark.range(6000).select("id", (F.col("id") % 2000).cast("string").alias("y"))
    assert S.mark_test_rows(df, "y", "id").where("is_test").count() == 1200
    half = spark.range(100).select("id", F.when(F.col("id") < 50, F.lit("a")).alias("y"))
    marked = S.mark_test_rows(half, "y", "id")
    assert marked.columns == ["id", "y", "is_test"] and marked.count() == 100
    assert sorted(r["count"] for r in marked.where("is_test").groupBy("y").count().collect()) == [10, 10]


def test_medians_leave_nan_out(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,)] + [(float("nan"),)] * 4 + [(None,)], "v double")
    assert [R.median_cuts(df, ["v"], method).first()[0] for method in ("sliced", "few_values", "sketch")] == [2.0] * 3


def test_one_class_is_refused_before_the_fit(spark):
    with pytest.raises(ValueError, match="both classes"):
        C.fit_ensemble(_planted(spark).where("y = 1"), ["a", "b"], "y")


def test_empty_chains(spark):
    from scorelab.functions.banding import band
    from scorelab.functions.encode import ordinal

    row = spark.range(1).select(band("id", [], ["all"], null_in_last=True).alias("b"), ordinal("id", {}, default=0).alias("o")).first()
    assert (row.b, row.o) == ("all", 0)


def test_text_follows_the_binary_value(spark):
    values = [2.675, 0.15, 0.25, 0.35, 2.5, -2.675, -0.04, 0.0, 1e15, 123456789.125, 0.375, 1e20, 99.995, 1 / 3]
    values += [random.Random(i).uniform(-1000, 1000) for i in range(200)] + [i / 200 for i in range(400)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    from scorelab.functions import fixed_text

    for places in (0, 1, 2, 3):
        assert [r[0] for r in df.select(fixed_text("v", places)).collect()] == [f"{v:.{places}f}" for v in values]


def test_lineage_follows_the_specs():
    assert {"TrustScore", "UsageScore", "Sentiment"} <= set(models.label_lineage())
    assert "UsageFreq" in models.label_lineage(allowed=())
    C.check_leakage(V.PREDICTORS, models.label_lineage())
    with pytest.raises(ValueError, match="AIModelCount"):
        C.check_leakage(V.PREDICTORS, models.label_lineage(allowed=["UsageFreq", "AgentDepth", "WorkflowIntegration"]))


def test_running_totals_without_exchange_reuse(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"), F.lit(2).alias("n"))
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        rows = R.running_totals(df, ["g"], "v", ["n"]).collect()
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")
    assert len(rows) == 5000 and all(r.n_before == 2 * (r.v // 3) for r in rows)


def test_fits_depend_on_stated_partitions_only(spark):
    """The same rows in other files and orders give the same fit."""
    rows = _planted(spark)
    found = []
    for given in (rows, rows.repartition(7, "b")):
        vectors = K.standardized_vectors(given, ["a", "b"], ["id", "y"])
        model = K.best_kmeans(vectors, "id", [3], starts=2, parts=4)[3]
        forest = C.fit_ensemble(given, ["a", "b"], "y", seeds=(1,), trees=5, depth=4, key="id", parts=4)
        found.append((sorted(tuple(round(x, 9) for x in c) for c in model.centres), C.feature_importance(forest, spark).collect()))
    assert found[0] == found[1]
