"""Standardising, k-means, silhouettes and projections on Spark ML."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from math import fsum
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorelab.functions.encode import named
from scorelab.operators.sampling import bounded_sample
from scorelab.operators.segments import one_row
from scorelab.session import dealt, materialise

#: Rows of the sample on which the starts of k-means run.
CORESET = 20_000
BLOCK_ROWS = 500  # about so many rows of a bounded sample are compared with as many others at a time


def standardize(df: DataFrame, columns: Sequence[str], suffix: str = "_z") -> DataFrame:
    """Add ``(x - mean) / population deviation`` per column; a constant column becomes 0.

    Means and deviations come from one aggregate and stay inside the plan.
    """
    stats = one_row(
        df.agg(
            *[F.avg(named(c)).alias(f"m{i}") for i, c in enumerate(columns)],
            *[F.stddev_pop(named(c)).alias(f"s{i}") for i, c in enumerate(columns)],
        )
    )
    scaled = {}
    for i, c in enumerate(columns):
        deviation = stats.getField(f"s{i}")
        unit = F.when(deviation == 0, F.lit(1.0)).otherwise(deviation)
        scaled[f"{c}{suffix}"] = (named(c) - stats.getField(f"m{i}")) / unit
    return df.withColumns(scaled)


def standardized_vectors(df: DataFrame, columns: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Complete rows with a standardised ``features`` vector.  Write them to a table
    before fitting: every fit reads them many times."""
    names = list(dict.fromkeys([*keep, *columns]))
    complete = df.select(*[named(c) for c in names]).dropna(subset=list(columns))
    scaled = standardize(complete, columns)
    vectors = VectorAssembler(inputCols=[f"{c}_z" for c in columns], outputCol="features").transform(scaled)
    return vectors.select(*[named(c) for c in names], "features")


def in_parallel(spark: SparkSession, tasks: Iterable[Callable], workers: int) -> list:
    """Run independent fits from a few client threads; each fit is itself a set of
    distributed jobs, so this only fills gaps between them."""
    wrapped = [inheritable_thread_target(spark)(task) for task in tasks]
    with ThreadPool(max(1, workers)) as pool:
        return pool.map(lambda task: task(), wrapped)


@dataclass(frozen=True)
class Clustering:
    """Centres, the summed squared distances of all rows to the nearest one, and the rounds over all rows."""

    centres: tuple[tuple[float, ...], ...]
    cost: float
    rounds: int


def _nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of and squared distance to each point's nearest centre; differences, not products, so near ones stay exact."""
    distances = np.stack([((points - c) ** 2).sum(axis=1) for c in centres], axis=1)
    found = distances.argmin(axis=1)
    return found, distances[np.arange(len(points)), found]


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.values.to_numpy(zero_copy_only=False)[column.offsets[0].as_py() : column.offsets[-1].as_py()]).reshape(len(column), -1)


def coreset(vectors: DataFrame, key: str, size: int, seed: int) -> DataFrame:
    """(features, weight): a sample of about ``size`` rows on which any centres cost about what they cost on all rows.

    A row is kept with probability size * (1 / 2n + d / 2D), d its squared distance to the mean and
    D their sum, and weighs one over that: far rows are kept more often and weigh less.  With
    ``size / 2`` rows or fewer all are kept with weight one.  Draws are hashes of the key.
    """
    whole = vectors.select(Summarizer.metrics("mean", "variance", "count").summary(F.col("features")).alias("s")).select("s.*").first()
    n, mean = whole["count"], np.array(whole["mean"].toArray() if whole["count"] else [])
    spread = float(np.sum(whole["variance"].toArray())) * (n - 1) if n > 1 else 0.0
    draws = F.xxhash64(named(key), F.lit(seed)).bitwiseAND(F.lit((1 << 52) - 1)) / F.lit(float(1 << 52))

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            distance = ((_matrix(batch.column(0)) - mean) ** 2).sum(axis=1)
            share = 0.5 / n + (0.5 * distance / spread if spread else 0.5 / n)
            chance = np.minimum(1.0, size * share)
            kept = pa.array(batch.column(1).to_numpy() < chance)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / chance)], names=["point", "weight"]).filter(kept)

    rows = vectors.select(vector_to_array("features").alias("point"), draws.alias("draw"))
    return rows.mapInArrow(run, "point array<double>, weight double").select(array_to_vector("point").alias("features"), "weight")


def packed(vectors: DataFrame) -> DataFrame:
    """(block): the points of (features), some thousands to a row as the bytes of their matrix.

    Rounds read matrices instead of building them from rows each time.  An empty table has no blocks.
    """
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array([_matrix(batch.column(0)).tobytes()], pa.binary())], names=["block"])

    return vectors.select(vector_to_array("features").alias("point")).mapInArrow(run, "block binary")


def finished(blocks: DataFrame, centres: dict[int, Sequence[Sequence[float]]], max_iter: int, tol: float = 1e-4) -> dict[int, Clustering]:
    """All sets of centres moved over all points (``packed``) until they stay, as Lloyd's rounds.

    A round sends the centres to the tasks and gets one count, sum and cost per task and centre; a
    centre that loses all rows stays where it is.  The sets that still move share their rounds, so the points are
    read once a round however many sets there are.
    """
    now = {k: np.array(c, float) for k, c in centres.items()}
    done: dict[int, Clustering] = {}
    rounds = 0
    while len(done) < len(now):
        held = {k: c for k, c in now.items() if k not in done}

        def run(batches, held=held):
            counts, costs = {k: np.zeros(len(c), np.int64) for k, c in held.items()}, {k: np.zeros(len(c)) for k, c in held.items()}
            sums = {k: np.zeros_like(c) for k, c in held.items()}
            for batch in batches:
                for block in batch.column(0):
                    matrix = np.frombuffer(block.as_buffer(), float)
                    for k, own in held.items():
                        points = matrix.reshape(-1, own.shape[1])
                        found, distance = _nearest(points, own)
                        counts[k] += np.bincount(found, minlength=len(own))
                        costs[k] += np.bincount(found, distance, minlength=len(own))
                        sums[k] += np.stack([np.bincount(found, column, minlength=len(own)) for column in points.T], axis=1)
            many = [len(c) for c in held.values()]
            columns = [pa.array(np.repeat(list(held), many), pa.int32()), pa.array(np.concatenate([np.arange(n) for n in many]), pa.int32()), pa.array(np.concatenate(list(counts.values()))),
                       pa.array([row for total in sums.values() for row in total], pa.list_(pa.float64())), pa.array(np.concatenate(list(costs.values())))]
            yield pa.RecordBatch.from_arrays(columns, names=["k", "centre", "n", "total", "cost"])

        parts = blocks.mapInArrow(run, "k int, centre int, n long, total array<double>, cost double").toArrow()  # tasks times centres small rows
        of, index, n, costs = (parts.column(c).to_numpy() for c in ("k", "centre", "n", "cost"))
        rows = np.array(parts.column("total").to_pylist(), float)
        for k, own in held.items():
            mine = of == k
            count, total = np.bincount(index[mine], n[mine], minlength=len(own)), np.zeros_like(own)
            # fsum: the same sums in whatever order the tasks answer.
            for c in range(len(own)):
                total[c] = [fsum(column) for column in rows[mine & (index == c)].T] or 0
            cost = fsum(costs[mine])
            moved = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], own)
            if rounds == max_iter or np.sqrt(((moved - own) ** 2).sum(axis=1)).max() <= tol:
                done[k] = Clustering(tuple(tuple(map(float, c)) for c in own), cost, rounds)
            now[k] = moved
        rounds += 1
    return done


def _moved_start(points: np.ndarray, weights: np.ndarray, centres: np.ndarray, max_iter: int, tol: float = 1e-4) -> tuple[float, np.ndarray]:
    """Weighted Lloyd rounds as Spark ML does them: the cost is that of the last round's assignment."""
    cost, weighted = 0.0, points * weights[:, None]
    for _ in range(max_iter):
        found, distance = _nearest(points, centres)
        cost, mass = float(distance @ weights), np.bincount(found, weights, minlength=len(centres))
        total = np.stack([np.bincount(found, column, minlength=len(centres)) for column in weighted.T], axis=1)
        moved = np.where(mass[:, None] > 0, total / np.where(mass > 0, mass, 1)[:, None], centres)
        still = ((moved - centres) ** 2).sum(axis=1).max() <= tol * tol
        centres = moved
        if still:
            break
    return cost, centres


def moved_starts(sample: DataFrame, starts: Sequence[tuple[int, int, list[list[float]]]], max_iter: int) -> list[tuple[int, int, float, list]]:
    """(k, turn, cost, centres) of the ``starts`` (k, turn, centres) moved over the bounded weighted ``sample`` until they stay.

    One task per start; the sample, one row of bytes, goes to every task.
    """
    def whole(batches):
        points, weights = [], []
        for batch in batches:
            if batch.num_rows:
                points.append(_matrix(batch.column(0)))
                weights.append(batch.column(1).to_numpy())
        if points:
            yield pa.RecordBatch.from_arrays([pa.array([np.concatenate(points).tobytes()], pa.binary()), pa.array([np.concatenate(weights).tobytes()], pa.binary())], names=["points", "weights"])

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                own = np.array(row["centres"], float)
                cost, moved = _moved_start(np.frombuffer(row["points"], float).reshape(-1, own.shape[1]), np.frombuffer(row["weights"], float), own, max_iter)
                yield pa.RecordBatch.from_arrays([pa.array([row["k"]], pa.int32()), pa.array([row["turn"]], pa.int32()), pa.array([cost]), pa.array([moved.tolist()], pa.list_(pa.list_(pa.float64())))],
                                                 names=["k", "turn", "cost", "centres"])

    one = sample.select(vector_to_array("features").alias("point"), "weight").mapInArrow(whole, "points binary, weights binary")
    asked = sample.sparkSession.createDataFrame(starts, "k int, turn int, centres array<array<double>>").repartition(len(starts))
    found = asked.crossJoin(F.broadcast(one)).mapInArrow(run, "k int, turn int, cost double, centres array<array<double>>")
    return sorted(tuple(row) for row in found.collect())  # one small row per start


def best_kmeans(vectors: DataFrame, key: str, ks: Sequence[int], seed: int = 42, starts: int = 10,
                workers: int = 8, max_iter: int = 300, parts: int | None = None, size: int = CORESET) -> dict[int, Clustering]:
    """Per k the cheapest of several seeded starts, moved over all rows until its centres stay.

    The starts run on one weighted coreset of about ``size`` rows, so the number of passes over all
    rows does not grow with the starts; inertia and final centres are those of all rows.  Spark ML
    draws the starts, tasks move them, one each.  Rows are dealt by a hash of ``key`` into ``parts``
    partitions: the same fit on any number of cores.
    """
    rows = dealt(vectors.select(named(key), "features"), key, parts).persist()
    blocks = packed(rows).persist()
    # A bounded sample: one partition, so that drawing a start is one task a step.  All tasks choose it; a shuffle,
    # unlike coalesce, keeps one task from reading every row.  Numbers keep its order.
    sample = coreset(rows, key, size, seed).withColumn("_at", F.monotonically_increasing_id())
    small = materialise(sample.repartition(1).sortWithinPartitions("_at").drop("_at"), "coreset").coalesce(1).persist()

    def drawn(k: int, turn: int) -> Callable[[], tuple[int, int, list]]:
        # No round: the model is the start itself.
        estimator = KMeans(k=k, seed=seed + turn, maxIter=0, featuresCol="features", weightCol="weight")
        return lambda: (k, turn, [list(map(float, c)) for c in estimator.fit(small).clusterCenters()])

    try:
        begun = in_parallel(vectors.sparkSession, [drawn(k, turn) for k in ks for turn in range(starts)], workers)
        tried = moved_starts(small, begun, max_iter)
        best = {k: min((t for t in tried if t[0] == k), key=lambda t: t[2])[3] for k in ks}
        found = finished(blocks, best, max_iter)
    finally:
        blocks.unpersist()
        rows.unpersist()
        small.unpersist()
    return {k: found[k] for k in ks}


def assign_clusters(vectors: DataFrame, model: Clustering, name: str = "Cluster") -> DataFrame:
    """Cluster per row.  Ids follow the centres in descending order, so equal
    clusterings carry equal ids whatever the start."""
    centres = np.array(sorted(model.centres, reverse=True))

    @F.pandas_udf("int")
    def nearest(points: pd.Series) -> pd.Series:
        return pd.Series(_nearest(np.stack(points.to_list()), centres)[0].astype(np.int32) if len(points) else np.zeros(0, np.int32))

    return vectors.withColumn(name, nearest(vector_to_array("features")))


def kmeans_scan(
    vectors: DataFrame,
    key: str,
    ks: Sequence[int] = (2, 3, 4, 5, 6),
    seed: int = 42,
    starts: int = 10,
    sample_cap: int | None = None,
    workers: int = 8,
    models: dict[int, Clustering] | None = None,
) -> DataFrame:
    """(k, inertia, silhouette, iterations) sorted by k.

    The silhouette is the squared-Euclidean one over all rows; with a
    ``sample_cap`` it is the Euclidean one on a sample of that size.  ``models``
    are those of ``best_kmeans``, fitted here if not given.
    """
    models = models or best_kmeans(vectors, key, ks, seed, starts, workers)

    def score(k: int) -> Callable[[], float]:
        marked = assign_clusters(vectors, models[k])
        if sample_cap is None:
            return lambda: silhouette_all(marked, "Cluster").first()[0]
        points = marked.withColumn("features", vector_to_array("features"))
        return lambda: silhouette_sampled(points, "Cluster", "features", key, sample_cap, seed).first()[0]

    scores = in_parallel(vectors.sparkSession, [score(k) for k in ks], workers)
    rows = [(k, models[k].cost, float(s), models[k].rounds) for k, s in zip(ks, scores)]
    return vectors.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double, iterations int").orderBy("k")


def silhouette_all(df: DataFrame, cluster: str, features: str = "features") -> DataFrame:
    """Squared-Euclidean silhouette over every row, linear in the rows."""
    value = ClusteringEvaluator(
        featuresCol=features, predictionCol=cluster, metricName="silhouette", distanceMeasure="squaredEuclidean"
    ).evaluate(df)
    return df.sparkSession.createDataFrame([(value,)], "silhouette double")


def silhouette_sampled(df: DataFrame, cluster: str, features: str, key: str, cap: int = 5000, seed: int = 42
                       ) -> DataFrame:
    """Euclidean silhouette on at most ``cap`` rows drawn by key hash.

    Only the sample is compared with itself.  It is packed into blocks of about 500
    rows; a task gets two blocks and returns, per row and cluster, the sum of
    distances and the number of rows met.
    """
    blocks = -(-cap // BLOCK_ROWS)
    points = df.select(named(key).cast("string").alias("_key"), named(cluster).cast("int").alias("_own"),
                       named(features).cast("array<double>").alias("_point"))
    # Both sides of the comparison read the written sample; the table is not drawn from twice.
    sample = materialise(bounded_sample(points, "_key", cap, seed), "sample")
    packed = (
        sample.groupBy(F.pmod(F.xxhash64("_key"), F.lit(blocks)).cast("int").alias("_block"))
        .agg(F.collect_list(F.struct("_key", "_own", "_point")).alias("_rows"))
        .select("_block", F.col("_rows._key").alias("keys"), F.col("_rows._own").alias("owns"),
                F.flatten(F.col("_rows._point")).alias("points"))
    )
    left = packed.withColumn("_with", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = packed.select(F.col("_block").alias("_with"), F.col("owns").alias("other_owns"),
                          F.col("points").alias("other_points"))

    def block_distances(batches):
        import numpy as np
        import pandas as pd

        for batch in batches:
            for row in batch.itertuples(index=False):
                others = np.asarray(row.other_owns)
                a = np.asarray(row.points).reshape(len(row.keys), -1)
                b = np.asarray(row.other_points).reshape(len(others), -1)
                clusters, place = np.unique(others, return_inverse=True)
                # One row against a block at a time: its distances are added up per cluster at once.
                sums = np.stack([np.bincount(place, np.sqrt(((b - p) ** 2).sum(axis=1))) for p in a])
                met = np.bincount(place)
                yield pd.concat(
                    pd.DataFrame({"_key": row.keys, "_own": row.owns, "_other": int(c), "_sum": sums[:, i], "_met": int(met[i])})
                    for i, c in enumerate(clusters)
                )

    pairs = left.join(right, "_with").select("keys", "owns", "points", "other_owns", "other_points")
    met = pairs.mapInPandas(block_distances, "_key string, _own int, _other int, _sum double, _met long")
    per_cluster = met.groupBy("_key", "_own", "_other").agg(F.sum("_sum").alias("_sum"), F.sum("_met").alias("_met"))
    own = F.col("_own") == F.col("_other")
    per_row = per_cluster.groupBy("_key").agg(
        # The row itself is among its own cluster, at distance 0.
        F.max(F.when(own, F.try_divide(F.col("_sum"), F.col("_met") - 1))).alias("_a"),
        F.min(F.when(~own, F.col("_sum") / F.col("_met"))).alias("_b"),
    )
    width = F.coalesce(F.try_divide(F.col("_b") - F.col("_a"), F.greatest("_a", "_b")), F.lit(0.0))
    return per_row.agg(F.avg(width).alias("silhouette"))


def cluster_summary(df: DataFrame, columns: Sequence[str], cluster: str = "Cluster", places: int = 3,
                    count: str = "DeveloperCount") -> DataFrame:
    """Means (rounded half-even) and size per cluster, in one aggregate."""
    return (
        df.groupBy(named(cluster))
        .agg(*[F.bround(F.avg(named(c)), places).alias(c) for c in columns], F.count(F.lit(1)).alias(count))
        .orderBy(named(cluster))
    )


def project_2d(vectors: DataFrame, names: tuple[str, str] = ("PC1", "PC2")) -> DataFrame:
    """First two principal components, fitted on all rows.  The sign of each is
    set so that its largest loading is positive."""
    model = PCA(k=2, inputCol="features", outputCol="_pc").fit(vectors)
    loadings = model.pc.toArray()
    signs = [1.0 if column[abs(column).argmax()] >= 0 else -1.0 for column in loadings.T]
    projected = model.transform(vectors).withColumn("_pc", vector_to_array("_pc"))
    return projected.withColumns(
        {name: F.col("_pc")[i] * F.lit(signs[i]) for i, name in enumerate(names)}
    ).drop("_pc")
