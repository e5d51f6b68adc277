"""Multi-line CSV read by byte ranges.

Whether a line break ends a record depends on the quotes before it: inside an open quote it is
part of an answer.  What counts is the parity of the quotes, and parities of consecutive
ranges add up, so each range of a file is scanned on its own, the parities are summed in file
order, and then every range knows whether it starts inside an answer.  Tasks cut their ranges
into records; only the pieces of records that cross a border are put together by a shuffle.
Spark's own CSV expression parses the records.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorelab import vocabulary as V

QUOTE = '"'
#: Characters of whole records that a task hands on at a time.
BATCH = 1 << 22


def range_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, start, line): every line with the byte range of the file that it begins in."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("line"))


def open_ranges(lines: DataFrame) -> DataFrame:
    """(file, start, inside): whether a range begins inside a quoted answer.  One row per range.

    An empty range has no row and changes nothing.
    """
    quotes = F.sum(F.length("line") - F.length(F.replace("line", F.lit(QUOTE), F.lit("")))) % 2
    parity = lines.groupBy("file", "start").agg(quotes.alias("odd"))
    before = W.partitionBy("file").orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    return parity.select("file", "start", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("inside"))


def cut_records(lines: DataFrame) -> DataFrame:
    """(file, start, place, whole, text) of the rows (file, start, line, inside).

    ``whole`` records lie in one range.  Others are pieces: place 0 continues a record of an earlier
    range, place 1 begins one that a later range continues.  The first record of a file has
    place 2.
    """
    schema = T.StructType.fromDDL("file string, start long, place int, whole boolean, text string")

    def run(batches):
        arrow = pa.schema([("file", pa.string()), ("start", pa.int64()), ("place", pa.int32()), ("whole", pa.bool_()), ("text", pa.string())])
        out, size = [], 0
        here, held, inside, first, carried = None, [], False, False, False

        def close():
            """What is open at the end of a range is a piece of a longer record."""
            if here is not None and held:
                out.append((*here, 0 if carried else 1, False, "\n".join(held)))

        def sent():
            batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)
            out.clear()
            return batch

        for batch in batches:
            for file, start, line, opened in zip(*(c.to_pylist() for c in batch.columns)):
                if (file, start) != here:
                    close()
                    here, held, inside, first, carried = (file, start), [], opened, start == 0, opened
                held.append(line)
                size += len(line)
                if line.count(QUOTE) % 2:
                    inside = not inside
                if not inside:
                    # A record that an earlier range began is a piece, all others are whole.
                    out.append((file, start, 0 if carried else 2 if first else 1, not carried, "\n".join(held)))
                    held, first, carried = [], False, False
            if size > BATCH and out:
                yield sent()
                size = 0
        close()
        if out:
            yield sent()

    return lines.select("file", "start", "line", "inside").mapInArrow(run, schema)


def joined_pieces(pieces: DataFrame) -> DataFrame:
    """(place, text): records put together from their pieces in file order.

    A record begins with a piece of place 1; all pieces of place 0 up to the next one belong to it.
    They are found by ranges, not by texts, and grouped by the range the record begins in.
    """
    order = W.partitionBy("file").orderBy("start", "place")
    begun = F.last(F.when(F.col("place") != 0, F.col("start")), ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, 0))
    parts = pieces.withColumn("begun", begun)
    whole = parts.groupBy("file", "begun").agg(F.array_sort(F.collect_list(F.struct("start", "text"))).alias("parts"))
    return whole.select(F.lit(1).alias("place"), F.array_join("parts.text", "\n").alias("text"))


def read_split_csv(spark: SparkSession, path: str | list[str], columns: Sequence[str] | None = None,
                   null_token: str = V.NULL_TOKEN) -> DataFrame:
    """The rows that ``read_survey_csv`` gives, with every file read in as many ranges as Spark makes of it.

    Quotes have to follow the rule of the format: an answer with a quote, a comma or a line break
    is quoted whole, quotes inside are doubled.  ``columns`` gives the full header and saves the
    small job that reads it.  Compressed files are one range each.  The files are read twice, the
    first time only for their quotes.  A header may not cross a range.
    """
    options = {"header": True, "multiLine": True, "escape": QUOTE, "nullValue": null_token}
    names = list(columns) if columns is not None else spark.read.options(**options).csv(path).columns
    lines = range_lines(spark, path)
    # One row per range: 60 bytes for some 100 MB of files, 60 MB for 100 TB.
    cut = cut_records(lines.join(F.broadcast(open_ranges(lines)), ["file", "start"]))
    records = cut.where("whole").select("place", "text").unionAll(joined_pieces(cut.where("NOT whole").drop("whole")))
    # Both line ends of the format close a record; blank lines are none.
    records = records.where("place <> 2").select(F.regexp_replace("text", "\r$", "").alias("text")).where("text <> ''")
    parsed = F.from_csv("text", _ddl(names), {"multiLine": "true", "escape": QUOTE, "nullValue": null_token})
    return records.select(parsed.alias("row_")).select("row_.*")


def _ddl(names: Sequence[str]) -> str:
    quoted = ("`" + name.replace("`", "``") + "`" for name in names)
    return ", ".join(f"{name} string" for name in quoted)
