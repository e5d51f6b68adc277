"""A questionnaire-shaped frame from the supplied ``orders`` table.

One response per order, every answer a text column computed from that row alone:
no join, no grouping, so the frame costs one narrow scan at any size.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorelab import vocabulary as V
from scorelab.operators.clean import clean_responses
from scorelab.operators.scores import score_responses
from scorelab.session import scratch_path, spread
from scorelab.sources import read_version, write_version

# --- fixed values: answer texts used by the frame ----------------------------
ROLES = [
    "Developer, full-stack",
    "Developer, back-end",
    "Developer, front-end",
    "Developer, AI apps or physical AI",
    "AI/ML engineer",
    "Developer, embedded applications or devices",
    "Developer, game or graphics",
    "Developer, desktop or enterprise applications",
    "Data engineer",
    "Architect, software or solutions",
    "Student",
]
WORK_MODES = [
    "Remote",
    "In-person",
    "Hybrid (some remote, leans heavy to in-person)",
    "Hybrid (some in-person, leans heavy to flexibility)",
    "Your choice (very flexible, you can come in when you want or just as needed)",
    "Somewhere else",
]
UNSURE_COMPLEX = "I don't use AI tools for complex tasks / I don't know"
UNSURE_SENTIMENT = "Unsure"
# --- end of fixed values -----------------------------------------------------


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _pick(index: Column, texts: list[str]) -> Column:
    """The index-th text, null beyond the list."""
    return F.get(F.array(*[F.lit(text) for text in texts]), index.cast("int"))


def _tokens(digits: Column) -> Column:
    """'3772' becomes '3;7;7;2'."""
    return F.array_join(F.split(digits, ""), ";")


def responses(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """Raw responses: all text, nulls where a question was skipped.  ``orders`` are those of the table, however dealt."""
    order, customer = F.col("o_orderkey"), F.col("o_custkey")
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    digits, backwards = cents.cast("string"), F.reverse(cents.cast("string"))
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    usage, agents = list(V.USAGE_POINTS), list(V.AGENT_POINTS)

    problems = _tokens(F.left(F.reverse(order.cast("string")), (1 + customer % 6).cast("int")))
    problems = F.replace(problems, F.lit("8"), F.lit(V.NOT_A_PROBLEM[0]))
    problems = F.replace(problems, F.lit("9"), F.lit(V.NOT_A_PROBLEM[1]))
    work_years, code_years = F.floor(F.col("o_totalprice")) % 60, cents % 54

    def skipped(condition: Column, value: Column) -> Column:
        return F.when(condition, F.lit(None).cast("string")).otherwise(value)

    return (load(spark, sf_dir, "orders") if orders is None else orders).select(
        order.cast("string").alias("ResponseId"),
        _pick(order % 3, ["I am a developer by profession", "I code sometimes"]).alias("MainBranch"),
        F.when(work_years <= 52, work_years.cast("string"))
        .when(work_years == 53, F.lit("not stated"))
        .when(work_years == 57, F.lit("5.5"))
        .when(work_years == 58, F.lit("10.5"))
        .alias("WorkExp"),
        F.when(code_years == 0, F.lit("Less than 1 year"))
        .when(code_years == 51, F.lit("More than 50 years"))
        .when(code_years == 52, F.lit("not stated"))
        .when(code_years == 53, F.lit(None).cast("string"))
        .otherwise(code_years.cast("string"))
        .alias("YearsCode"),
        _pick(customer % 12, ROLES).alias("DevType"),
        _pick(customer % 7, WORK_MODES).alias("RemoteWork"),
        skipped(customer % 27 == 26, F.concat(F.lit("NATION_"), (customer % 25).cast("string"))).alias("Country"),
        _pick(customer % 4, ["Software", "Finance", "Retail"]).alias("Industry"),
        _pick(order % 4, ["Yes", "I'm not sure", "No"]).alias("AIThreat"),
        F.when(priority == "1-URGENT", F.lit(usage[0]))
        .when(priority == "2-HIGH", F.lit(usage[1]))
        .when(priority == "3-MEDIUM", F.lit(usage[2]))
        .when((priority == "5-LOW") & (order % 2 == 0), F.lit(usage[3]))
        .when(priority == "5-LOW", F.lit(usage[4]))
        .alias("AISelect"),
        _pick(F.month("o_orderdate") % 7, [*V.SENTIMENT_POINTS, UNSURE_SENTIMENT]).alias("AISent"),
        _pick(customer % 6, list(V.ACCURACY_POINTS)).alias("AIAcc"),
        _pick(order % 7, [*V.COMPLEX_POINTS, UNSURE_COMPLEX]).alias("AIComplex"),
        skipped(customer % 5 == 0, _tokens(F.left(backwards, (1 + order % 8).cast("int")))).alias(
            "AIToolCurrently partially AI"
        ),
        skipped(status == "O", _tokens(F.left(digits, (1 + customer % 6).cast("int")))).alias(
            "AIToolCurrently mostly AI"
        ),
        skipped(customer % 13 == 0, problems).alias("AIFrustration"),
        F.when(status == "F", _pick(order % 3, agents[:3]))
        .when(status == "P", F.lit(agents[3]))
        .otherwise(_pick(customer % 3, agents[4:]))
        .alias("AIAgents"),
        skipped(
            customer % 11 == 0,
            _tokens(F.left(F.concat(digits, customer.cast("string")), (1 + order % 13).cast("int"))),
        ).alias("AIModelsHaveWorkedWith"),
        skipped(customer % 9 == 0, _tokens(F.left(backwards, (1 + order % 5).cast("int")))).alias(
            "DevEnvsHaveWorkedWith"
        ),
    )


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order keys are unique, so the cleaned table needs no de-duplication here.

    Orders are dealt anew where a file holds many, since scoring a row costs far more than reading it.
    """
    orders = spread(load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"))
    return clean_responses(responses(spark, sf_dir, orders), deduplicate=False)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_responses(cleaned(spark, sf_dir))


def rated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A prediction table with tied scores: truth, score and thresholded guess."""
    score = ((F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 104729) % 1000) / F.lit(1000.0)
    return load(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("y"),
        score.alias("score"),
        F.when(score >= 0.5, 1).otherwise(0).alias("guess"),
    )


SCORES = ("UsageScore", "TrustScore", "FrustrationScore", "AvgTrustScore")
_STAGES: dict[tuple[str, str, str], str] = {}


def stage(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A stage table in the shared folder, written once per application and input.

    Later queries scan only the columns they need from it, with their filters
    pushed down, as jobs that follow each other through tables do.
    """
    return read_version(spark, stage_path(spark, sf_dir, name, build))


def stage_path(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STAGES:
        path, df = scratch_path(spark, name), build()
        # What the quality checks ask of a table is observed while it is written.
        write_version(df, path, [c for c in SCORES if c in df.columns])
        _STAGES[key] = path
    return _STAGES[key]


def scored_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(spark, sf_dir, "scored", lambda: scored(spark, sf_dir))
