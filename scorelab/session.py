"""Session helpers: local session for tests and benches, shared scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Rows that a dealt partition holds on the average, at most.
PART_ROWS = 250_000
#: Rows that one task of a costly narrow stage gets on the average, at most.
SPREAD_ROWS = 100_000


def local_session(cpus: int | str = "*", app: str = "scorelab") -> SparkSession:
    """A one-machine session for tests and the bench; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        # HotSpot does not compile larger methods; wide projections then run split up.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster, one of
    local-cluster mode included, a machine-local path would vanish with its executor,
    so that is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="scorelab-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut the lineage by writing Parquet to the shared folder and reading it back.

    Iterative fits re-read their input many times; from a written table a lost
    executor costs one re-read instead of a recomputation of the whole plan.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def dealt(df: DataFrame, key: str, parts: int | None = None) -> DataFrame:
    """Rows in ``parts`` partitions by a hash of the key, in key order inside each.

    Seeded fits draw per partition, so partitions must depend on the data and on a stated
    number alone.  Without ``parts`` it is ``spark.sql.shuffle.partitions``, or more where they
    would hold over ``PART_ROWS`` rows each: one pass counts them.
    """
    if parts is None:
        parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // PART_ROWS))
    return df.repartition(parts, key).sortWithinPartitions(key)


def spread(df: DataFrame) -> DataFrame:
    """Rows in at least as many partitions as a costly narrow stage needs tasks.

    Compact files hold millions of rows in what one task reads.  The count comes from the files'
    footers; a small table is left as it is.
    """
    n = df.count()
    return df.repartition(-(-n // SPREAD_ROWS)) if n > SPREAD_ROWS else df
