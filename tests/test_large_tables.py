"""What must not grow with the rows: rounds of jobs, rows of one dealt partition, rows of one scoring task."""

from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from catalog import frames as R
from catalog import registry as G
from scorelab import session
from scorelab.operators import classify as C
from scorelab.operators import clustering as K
from scorelab.operators import deep_forest as D


def _points(spark, n=900):
    rows = spark.range(n).select(F.col("id").cast("string").alias("id"), *[(F.randn(i) + (F.col("id") % 5 == i).cast("int") * 2).alias(c) for i, c in enumerate("abc")])
    return K.standardized_vectors(rows, ["a", "b", "c"], ["id"]).cache()


def test_starts_of_kmeans_are_moved_in_one_job(spark):
    """Ten starts for two k: a job per round and start were over 500 jobs."""
    vectors = _points(spark)
    spark.sparkContext.setJobGroup("fit", "fit")
    found = K.best_kmeans(vectors, "id", [3, 5], starts=10)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("fit"))
    spark.sparkContext.setJobGroup("other", "other")
    assert jobs < 330, jobs
    assert found[3].cost > found[5].cost and len(found[5].centres) == 5


def test_dealt_partitions_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(session, "PART_ROWS", 50)
    rows = spark.range(1000)
    assert session.dealt(rows, "id").rdd.getNumPartitions() == 20
    assert session.dealt(rows.limit(60), "id").rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert session.dealt(rows, "id", 3).rdd.getNumPartitions() == 3


def test_scoring_tasks_grow_with_the_orders(spark, small, monkeypatch):
    plain = R.scored(spark, small)
    monkeypatch.setattr(session, "SPREAD_ROWS", 100)
    many = R.scored(spark, small)
    assert many.rdd.getNumPartitions() == 15 > plain.rdd.getNumPartitions()
    assert many.exceptAll(plain).count() == plain.exceptAll(many).count() == 0


def test_vectors_travel_to_the_leaves_of_forests_in_blocks(spark):
    """A row per vector and tree would be 600 x 20 rows; blocks hold the same vectors in as many rows as there are leaves."""
    rows = spark.range(600).select("id", F.col("id").cast("double").alias("a"), (F.col("id") % 2).cast("int").alias("y"))
    forest = C.fit_ensemble(rows, ["a"], "y", seeds=(1, 2), trees=10, depth=2, key="id")
    cells = rows.select(F.array("a").alias("features"), F.lit(1).cast("long").alias("n0"), F.col("id").alias("n1"))
    routed = D._routed(forest.members, 10, cells.coalesce(1))
    sent = D._sent(routed, 1, ["n0", "n1"]).collect()
    found = sorted((r.root, *row) for r in sent for row in np.frombuffer(r.block, float).reshape(-1, 3).tolist())
    expected = sorted((root, r.features[0], r.n0, r.n1) for r in routed.collect() for root in r.roots)
    assert found == expected and len(expected) == 12000
    assert len(sent) < 200
    assert D._largest(routed) == max(Counter(r[0] for r in expected).values())


def test_split_csv_is_written_by_more_than_one_task(spark, small, monkeypatch):
    """No task writes all documents, and the files are read by ranges."""
    seen = []
    write = G.write_survey_csv
    monkeypatch.setattr(G, "write_survey_csv", lambda df, path: seen.append(df.rdd.getNumPartitions()) or write(df, path))
    monkeypatch.setattr(G.R, "load", lambda s, d, t: s.read.parquet(f"{d}/{t}.parquet").repartition(3))
    found = G.QUERIES["csv_split_roundtrip"](spark, small)
    assert seen == [3] and found.count() == spark.read.parquet(f"{small}/documents.parquet").count()


def test_no_task_reads_all_rows_for_the_coreset(spark, monkeypatch):
    """Its rows are chosen by all tasks and shuffled to the one that writes them."""
    plans, write = [], K.materialise
    monkeypatch.setattr(K, "materialise", lambda df, name="stage": plans.append(df._jdf.queryExecution().toString()) or write(df, name))
    K.best_kmeans(_points(spark, 200), "id", [2], starts=1)
    assert len(plans) == 1 and "Coalesce 1" not in plans[0] and "SinglePartition" in plans[0]
