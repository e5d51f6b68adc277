"""Tables that are replaced as a whole, with facts observed while they are written.

Every write goes to a folder of its own beside the older ones; a record appended to the
table's history makes it the current one.  A write that fails midway leaves no record, so readers
keep the old table, and a table may be rewritten from itself.  Row count and value ranges are
observed on the rows as they are written and kept in the record: checks need no further scan.
One writer at a time; readers may be many.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from scorelab.functions.encode import named
from scorelab.sources.tables import is_missing_path

RECORD = "version long, folder string, rows long, columns array<string>, low map<string, double>, high map<string, double>"


@dataclass(frozen=True)
class Facts:
    """What was observed of a table while it was written; ranges skip nulls and are absent without values."""

    rows: int
    columns: tuple[str, ...]
    low: dict[str, float] = field(default_factory=dict)
    high: dict[str, float] = field(default_factory=dict)
    version: int = 0
    folder: str = ""


def _history(path: str) -> str:
    return f"{path.rstrip('/')}/_history"


def table_facts(spark: SparkSession, path: str) -> Facts | None:
    """Facts of the current version, None when there is none; reads one small record per version."""
    try:
        records = spark.read.schema(RECORD).json(_history(path))
        last = records.orderBy(F.desc("version"), F.desc("folder")).limit(1).collect()
    except AnalysisException as error:
        if is_missing_path(error):
            return None
        raise
    if not last:
        return None
    [r] = last
    return Facts(r.rows, tuple(r.columns), dict(r.low or {}), dict(r.high or {}), r.version, r.folder)


def write_version(df: DataFrame, path: str, ranges: Sequence[str] = ()) -> Facts:
    """Write ``df`` as the table's next version; ``ranges`` are numeric columns whose ends are observed.

    The observed rows are those of the writing tasks themselves, each task counted once.
    """
    spark = df.sparkSession
    # An empty history first, so that looking for the last version finds a folder.
    spark.createDataFrame([], RECORD).write.mode("ignore").json(_history(path))
    before = table_facts(spark, path)
    watch = Observation("facts")
    ends = [c for i, name in enumerate(ranges) for c in (F.min(named(name).cast("double")).alias(f"low{i}"), F.max(named(name).cast("double")).alias(f"high{i}"))]
    version = before.version + 1 if before else 1
    folder = f"v{version}-{uuid.uuid4().hex}"
    df.observe(watch, F.count(F.lit(1)).alias("rows"), *ends).write.parquet(f"{path.rstrip('/')}/{folder}")
    seen = watch.get
    low, high = ({name: seen[f"{end}{i}"] for i, name in enumerate(ranges) if seen[f"{end}{i}"] is not None} for end in ("low", "high"))
    facts = Facts(seen["rows"], tuple(df.columns), low, high, version, folder)
    record = spark.createDataFrame([(version, folder, facts.rows, list(facts.columns), low, high)], RECORD)
    record.coalesce(1).write.mode("append").json(_history(path))
    return facts


def read_version(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a table."""
    facts = table_facts(spark, path)
    if facts is None:
        raise FileNotFoundError(f"no table at {path}")
    return spark.read.parquet(f"{path.rstrip('/')}/{facts.folder}")
