"""Fits on data planted from the supplied tables, so that the right answer is known in SQL.

The twins state the planted rule; the queries find it by fitting.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from catalog import frames as R
from catalog.registry import long, query
from scorelab.operators import classify as C
from scorelab.operators import clustering as K
from scorelab.operators import deep_forest as D
from scorelab.operators import ranking
from scorelab.plans import models, views

SHOWN = ["UsageScore", "TrustScore", "FrustrationScore", "AgentDepth", "AIModelCount", "WorkflowIntegration", "WorkExpNum"]
NAMES = {i: (f"Segment {i}", f"Group {i}") for i in range(4)}


def _points(spark, sf_dir):
    """Four far groups by the line's key, with a small spread inside each."""
    key = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    group = key % 4
    plain = R.load(spark, sf_dir, "lineitem").select(
        key.alias("key"), (group * 100 + F.col("l_orderkey") % 3).cast("double").alias("UsageScore"),
        *[(group * (i + 2)).cast("double").alias(name) for i, name in enumerate(SHOWN[1:])],
    )
    return VectorAssembler(inputCols=["UsageScore", "TrustScore"], outputCol="features").transform(plain)


def _fit(spark, sf_dir):
    points = _points(spark, sf_dir)
    return points, K.best_kmeans(points, "key", [4], starts=3)


def _marked(spark, sf_dir):
    points, fitted = _fit(spark, sf_dir)
    return K.assign_clusters(points, fitted[4])


@query
def planted_clusters(spark, sf_dir):
    return _marked(spark, sf_dir).select("key", long("Cluster"))


@query
def planted_scan(spark, sf_dir):
    """Inertia and silhouette of the planted groups, over all rows."""
    points, fitted = _fit(spark, sf_dir)
    return K.kmeans_scan(points, "key", models=fitted, ks=[4]).select(long("k"), "inertia", "silhouette")


@query
def planted_scan_table(spark, sf_dir):
    """The scan as display text."""
    points, fitted = _fit(spark, sf_dir)
    return views.scan_table(K.kmeans_scan(points, "key", models=fitted, ks=[4])).select(
        long("Clusters (k)"), "Silhouette")


@query
def planted_summary(spark, sf_dir):
    return K.cluster_summary(_marked(spark, sf_dir), SHOWN).withColumn("Cluster", long("Cluster"))


@query
def planted_names(spark, sf_dir):
    return views.named_clusters(K.cluster_summary(_marked(spark, sf_dir), SHOWN), NAMES).withColumn("Cluster", long("Cluster"))


@query
def planted_axis(spark, sf_dir):
    """Points on a line through the origin: all along the first component, nothing on the second."""
    line = R.load(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 100).cast("double").alias("x"))
    vectors = VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(line.withColumn("y", F.col("x") * 2))
    return K.project_2d(vectors).select("o_orderkey", "PC1", F.round("PC2", 6).alias("PC2"))


@query
def planted_points(spark, sf_dir):
    """A sample, smaller than the table, of projected and clustered rows."""
    projected = K.project_2d(_marked(spark, sf_dir))
    return views.cluster_points(projected, "key", cap=500).select("key", long("Cluster"), "ClusterLabel")


def _ensemble(spark, sf_dir):
    """A label that one predictor with five values decides; the other predictor is constant."""
    rows = R.load(spark, sf_dir, "orders").select(
        "o_orderkey", (F.col("o_custkey") % 5).cast("double").alias("steps"), F.lit(1.0).alias("flat"),
        (F.col("o_custkey") % 5 >= 3).cast("int").alias("y"),
    )
    train, test = rows.where("o_orderkey % 7 <> 0"), rows.where("o_orderkey % 7 = 0")
    fitted = C.fit_ensemble(train, ["steps", "flat"], "y", seeds=(42, 1337, 2025), trees=10, key="o_orderkey")
    return fitted, C.vote(fitted, test)


@query
def planted_votes(spark, sf_dir):
    return _ensemble(spark, sf_dir)[1].select("o_orderkey", long("y_true"), long("y_pred"))


@query
def planted_deep_votes(spark, sf_dir):
    """A label that alternates along 251 values: only leaves of single values know it, ten levels of 32 bins do not."""
    rows = R.load(spark, sf_dir, "orders").select(
        "o_orderkey", (F.col("o_orderkey") * 7 % 251).cast("double").alias("stripe"), F.lit(1.0).alias("flat"),
        (F.col("o_orderkey") * 7 % 251 % 2).cast("int").alias("y"),
    )
    forest = D.fit_deep_ensemble(rows, ["stripe", "flat"], "y", trees=10, key="o_orderkey")
    return D.vote_deep(forest, rows).select("o_orderkey", long("y_true"), long("y_pred"))


@query
def planted_importance(spark, sf_dir):
    importance = C.feature_importance(_ensemble(spark, sf_dir)[0], spark)
    return importance.select("Feature", "Importance")


@query
def planted_evaluation(spark, sf_dir):
    return models.evaluation_strip(_ensemble(spark, sf_dir)[1])


@query
def sketch_median_rank(spark, sf_dir):
    """The sketch's median is off by at most a thousandth of the rows."""
    prices = R.load(spark, sf_dir, "lineitem").select("l_extendedprice")
    guess = ranking.median_cuts(prices, ["l_extendedprice"], "sketch").scalar()
    return prices.agg(
        F.count("*").alias("n"),
        ((F.count_if(F.col("l_extendedprice") < guess) <= F.count("*") * 0.501 + 1)
         & (F.count_if(F.col("l_extendedprice") <= guess) >= F.count("*") * 0.499 - 1)).alias("within"),
    )


_POINTS = ("WITH p AS (SELECT l_orderkey * 8 + l_linenumber AS key, CAST((l_orderkey * 8 + l_linenumber) % 4 AS BIGINT) AS g, "
           "CAST((l_orderkey * 8 + l_linenumber) % 4 * 100 + l_orderkey % 3 AS DOUBLE) AS x FROM lineitem)")
_MEANS = ", ".join(f'CAST(g * {i + 2} AS DOUBLE) AS "{name}"' for i, name in enumerate(SHOWN[1:]))
_SCAN = _POINTS + """, q AS (SELECT g, x, CAST(g * 2 AS DOUBLE) AS y FROM p),
    c AS (SELECT g, avg(x) AS mx, avg(y) AS my, avg(x * x + y * y) AS m2, count(*) AS n FROM q GROUP BY g),
    d AS (SELECT q.g, c.g AS o, c.n, q.x, q.y, q.x * q.x + q.y * q.y - 2 * (q.x * c.mx + q.y * c.my) + c.m2 AS mean FROM q, c),
    s AS (SELECT g, x, y, max(CASE WHEN o = g THEN mean * n / (n - 1) END) AS a, min(CASE WHEN o <> g THEN mean END) AS b FROM d GROUP BY g, x, y),
    w AS (SELECT s.*, (SELECT count(*) FROM q WHERE q.g = s.g AND q.x = s.x AND q.y = s.y) AS weight FROM s)
    SELECT {} FROM w"""
_INERTIA = "(SELECT sum((q.x - c.mx) * (q.x - c.mx)) FROM q JOIN c USING (g))"
_WIDTH = "sum(weight * (b - a) / greatest(a, b)) / sum(weight)"
_LABELLED = "CAST(o_custkey % 5 >= 3 AS BIGINT)"

PLANTED = {
    "planted_clusters": _POINTS + ' SELECT key, 3 - g AS "Cluster" FROM p',
    "planted_scan": _SCAN.format(f"CAST(4 AS BIGINT) AS k, round({_INERTIA}, 6) AS inertia, round({_WIDTH}, 6) AS silhouette"),
    "planted_scan_table": _SCAN.format(f"""CAST(4 AS BIGINT) AS "Clusters (k)", printf('%.3f', {_WIDTH}) AS "Silhouette" """),
    "planted_summary": _POINTS + f""" SELECT 3 - g AS "Cluster", round_even(avg(x), 3) AS "UsageScore", {_MEANS}, count(*) AS "DeveloperCount" FROM p GROUP BY g""",
    "planted_names": _POINTS + f""" SELECT 3 - g AS "Cluster", 'Segment ' || (3 - g) AS "Segment", 'Group ' || (3 - g) AS "Meaning",
        count(*) AS "DeveloperCount", round_even(round_even(avg(x), 3), 2) AS "UsageScore", {_MEANS} FROM p GROUP BY g""",
    "planted_axis": 'SELECT o_orderkey, round(sqrt(5.0) * (o_custkey % 100), 6) AS "PC1", CAST(0 AS DOUBLE) AS "PC2" FROM orders',
    "planted_points": _POINTS + """ SELECT key, 3 - g AS "Cluster", 'Cluster ' || (3 - g) AS "ClusterLabel" FROM p
        QUALIFY row_number() OVER (ORDER BY md5('0:' || key)) <= 500""",
    "planted_votes": f"SELECT o_orderkey, {_LABELLED} AS y_true, {_LABELLED} AS y_pred FROM orders WHERE o_orderkey % 7 = 0",
    "planted_deep_votes": """SELECT o_orderkey, CAST(o_orderkey * 7 % 251 % 2 AS BIGINT) AS y_true,
        CAST(o_orderkey * 7 % 251 % 2 AS BIGINT) AS y_pred FROM orders""",
    "planted_importance": """SELECT * FROM (VALUES ('steps', CAST(1 AS DOUBLE)), ('flat', CAST(0 AS DOUBLE))) AS v("Feature", "Importance")""",
    "planted_evaluation": f"""SELECT count(*) AS n, CAST(1 AS DOUBLE) AS accuracy, round(avg(CAST(1 - {_LABELLED} AS DOUBLE)), 6) AS baseline_accuracy,
        CAST(1 AS DOUBLE) AS balanced_accuracy, CAST(1 AS DOUBLE) AS "precision", CAST(1 AS DOUBLE) AS recall, CAST(1 AS DOUBLE) AS f1,
        CAST(1 AS DOUBLE) AS roc_auc FROM orders WHERE o_orderkey % 7 = 0""",
    "sketch_median_rank": "SELECT count(*) AS n, true AS within FROM lineitem",
}
