"""Line dedup by distinct-site spread.

A line that stands on many sites is boilerplate.  Its spread is counted in two steps: a
HyperLogLog sketch per line hash, held as rows (line, register, rank) so that sketches merge
by a plain aggregate and a line on every page costs each task at most one row per register;
then an exact distinct count for the lines whose estimate lies near the threshold.  Boilerplate
lines go from every document but the first (smallest doc_id) that has them, so no wording is
lost from the corpus, and a group of copies keeps one whole member.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorelab.session import materialise

#: Sites from which on a line is boilerplate.
SPREAD = 10
#: log2 of the registers of a sketch: 64 registers, a standard error of 13 %.
REGISTER_BITS = 6
#: Estimates within so many standard errors of the threshold are counted exactly.
BAND = 4.0


def lines(text: Column) -> Column:
    return F.split(text, "\n")


def line_key(line: Column) -> Column:
    """Hash of a line without surrounding blanks."""
    return F.xxhash64(F.trim(F.regexp_replace(line, "[\\t\\r]", " ")))


def holdings(docs: DataFrame, site: str) -> DataFrame:
    """(line, site, doc_id) of every line that is not blank; a null site is a site of its own."""
    rows = docs.select(F.col("doc_id").alias("doc_"), F.coalesce(F.xxhash64(F.col(site).cast("string")), F.lit(0)).alias("site_"),
                       F.explode(lines(F.col("text").cast("string"))).alias("line_"))
    return rows.where(F.trim(F.regexp_replace("line_", "[\\t\\r]", " ")) != "").select(line_key(F.col("line_")).alias("line_"), "site_", "doc_")


def sketches(held: DataFrame, bits: int = REGISTER_BITS) -> DataFrame:
    """(line, register, rank, first holder): HyperLogLog sketches as rows, merged by max."""
    hashed = F.xxhash64("site_", F.lit(7))
    rest = F.shiftrightunsigned(hashed, bits)
    rank = F.lit(64 - bits + 1) - F.when(rest == 0, 0).otherwise(F.length(F.bin(rest)))
    register = F.pmod(hashed, F.lit(1 << bits))
    return held.groupBy("line_", register.cast("int").alias("register_")).agg(F.max(rank).alias("rank_"), F.min("doc_").alias("first_"))


def estimates(sketch: DataFrame, bits: int = REGISTER_BITS) -> DataFrame:
    """(line, estimate, first holder), with linear counting while registers are empty."""
    m = 1 << bits
    alpha = 0.7213 / (1 + 1.079 / m)
    by_line = sketch.groupBy("line_").agg(F.sum(F.pow(F.lit(2.0), -F.col("rank_"))).alias("sum_"), F.count("*").alias("used_"), F.min("first_").alias("first_"))
    empty = F.lit(m) - F.col("used_")
    raw = F.lit(alpha * m * m) / (F.col("sum_") + empty)
    estimate = F.when((raw <= 2.5 * m) & (empty > 0), F.lit(float(m)) * F.log(F.lit(float(m)) / empty)).otherwise(raw)
    return by_line.select("line_", estimate.alias("estimate_"), "first_")


def boilerplate(docs: DataFrame, site: str = "source", spread: int = SPREAD, bits: int = REGISTER_BITS) -> DataFrame:
    """(line_, first_): hashes of lines on at least ``spread`` sites, and their first holder.

    Estimates beyond the band decide by themselves; inside it sites are counted exactly, so a
    wrong decision needs an error of more than four standard errors.
    """
    held = holdings(docs, site)
    error = BAND * 1.04 / (1 << bits) ** 0.5
    near = materialise(estimates(sketches(held, bits), bits).where(F.col("estimate_") >= spread * (1 - error)), "spread")
    sure = near.where(F.col("estimate_") > spread * (1 + error)).select("line_", "first_")
    unsure = near.where(F.col("estimate_") <= spread * (1 + error)).select("line_", "first_")
    # One row per line and site leaves each task, so a hot line cannot pile up.
    exact = held.join(unsure, "line_").select("line_", "site_", "first_").distinct().groupBy("line_", "first_").agg(F.count("*").alias("sites_"))
    return sure.unionByName(exact.where(F.col("sites_") >= spread).select("line_", "first_"))


def drop_boilerplate(docs: DataFrame, site: str = "source", spread: int = SPREAD) -> DataFrame:
    """``docs`` with all its columns and rows, boilerplate lines taken out of ``text``.

    Documents without such lines keep their text as it is, nulls included; a document that
    holds nothing else is left with an empty text.  Repeated rows are treated alike, and where all
    holders of a line have a null doc_id the line stays.  ``n_chars``, when present, follows
    the new text.  What to remove depends on text and doc_id alone, so only line hashes are
    joined; the text itself moves once, and only by a join that Spark may broadcast.
    """
    bad = materialise(boilerplate(docs, site, spread), "boilerplate")
    lines_of = docs.select(F.xxhash64("text").alias("text_"), F.xxhash64(F.lit(1), "text").alias("check_"), "text").select(
        "text_", "check_", F.explode(lines(F.col("text").cast("string"))).alias("line_")).select("text_", "check_", line_key(F.col("line_")).alias("line_"))
    removal = lines_of.join(bad, "line_").where("first_ IS NOT NULL").distinct().groupBy("text_", "check_").agg(
        F.map_from_entries(F.collect_list(F.struct("line_", "first_"))).alias("removal_"))
    # Written, so that the join below may split a text that a third of the rows have.
    removal = materialise(removal, "removal")
    columns = {name: f"column_{i}_" for i, name in enumerate(docs.columns)}
    renamed = docs.toDF(*columns.values()).withColumns({"text_": F.xxhash64(columns["text"]), "check_": F.xxhash64(F.lit(1), columns["text"])})
    joined = renamed.join(removal, ["text_", "check_"], "left")
    text, own = F.col(columns["text"]), F.col(columns["doc_id"])

    def stays(line):
        first = F.element_at("removal_", line_key(line))
        return first.isNull() | first.eqNullSafe(own)

    new = F.when(F.col("removal_").isNull(), text).otherwise(F.array_join(F.filter(lines(text), stays), "\n"))
    out = joined.withColumn(columns["text"], new)
    if "n_chars" in columns:
        out = out.withColumn(columns["n_chars"], F.when(F.col("removal_").isNull(), F.col(columns["n_chars"])).otherwise(F.length(text).cast(dict(docs.dtypes)["n_chars"])))
    return out.select(*(F.col(temp).alias(name) for name, temp in columns.items()))


def line_digests(docs: DataFrame, site: str = "source", spread: int = SPREAD) -> DataFrame:
    """doc_id, n_lines before and after, n_removed and the digest of the remaining text, per row."""
    before = docs.select("doc_id", "text", F.col(site).alias("site"), F.size(lines(F.coalesce(F.col("text"), F.lit("")))).cast("long").alias("n_lines"))
    after = drop_boilerplate(before, "site", spread)
    left = F.when(F.coalesce(F.col("text"), F.lit("")) == "", 0).otherwise(F.size(lines(F.col("text")))).cast("long")
    return after.select("doc_id", "n_lines", left.alias("n_left"), F.sha2(F.coalesce(F.col("text"), F.lit("")), 256).alias("text_sha256"))
