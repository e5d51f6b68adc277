"""The seven standard reports over a scored table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorelab import vocabulary as V
from scorelab.functions.banding import band, experience_group
from scorelab.operators import profiles as P

AVERAGES = {
    "AvgUsageScore": "UsageScore",
    "AvgTrustScore": "TrustScore",
    "AvgFrustrationScore": "FrustrationScore",
}


def dataset_summary(scored: DataFrame) -> DataFrame:
    return P.summary(
        scored,
        distinct={"CountryCount": "Country", "DeveloperRoleCount": "DevType"},
        present={"RespondentsWithTrust": "TrustScore"},
        means=AVERAGES,
    ).select("TotalResponses", "RespondentsWithTrust", "CountryCount", "DeveloperRoleCount", *AVERAGES)


def usage_distribution(scored: DataFrame) -> DataFrame:
    return P.frequencies(scored, "AISelect")


def usage_band() -> Column:
    return band("UsageScore", V.USAGE_BAND_EDGES, V.USAGE_BANDS, null_in_last=True)


def trust_by_usage(scored: DataFrame) -> DataFrame:
    return P.profile(scored, [usage_band().alias("UsageBand")], AVERAGES, order=[F.col("AvgUsageScore")])


def trust_by_role(scored: DataFrame, min_count: int = 100) -> DataFrame:
    return P.profile(
        scored.where(P.known("DevType")), ["DevType"], AVERAGES, min_count,
        order=[F.col("AvgTrustScore").desc()],
    )


def experience_analysis(scored: DataFrame) -> DataFrame:
    return P.profile(
        scored, [experience_group("WorkExpNum").alias("ExperienceGroup")], AVERAGES,
        order=[F.col("AvgTrustScore").desc()],
    )


def quadrant_summary(quadrants: DataFrame) -> DataFrame:
    means = {
        **AVERAGES,
        "AvgAgentDepth": "AgentDepth",
        "AvgModelCount": "AIModelCount",
        "AvgWorkflowIntegration": "WorkflowIntegration",
    }
    return P.profile(quadrants, ["TrustUsageGroup"], means, order=[F.col(P.COUNT).desc()])


def focus_profile(quadrants: DataFrame, min_count: int = 20, quadrant: str = V.FOCUS_QUADRANT) -> DataFrame:
    """Role x country x work mode inside one quadrant."""
    inside = quadrants.where((F.col("TrustUsageGroup") == quadrant) & P.known("DevType"))
    means = {"AvgWorkExperience": "WorkExpNum", "AvgFrustration": "FrustrationScore", "AvgAgentDepth": "AgentDepth"}
    return P.profile(inside, ["DevType", "Country", "RemoteWork"], means, min_count, order=[F.col(P.COUNT).desc()])


def all_reports(scored: DataFrame, quadrants: DataFrame, role_support: int = 100, slice_support: int = 20
                ) -> dict[str, DataFrame]:
    """Report name to DataFrame, as they are written to disk."""
    return {
        "dataset_summary": dataset_summary(scored),
        "ai_usage_distribution": usage_distribution(scored),
        "trust_by_usage": trust_by_usage(scored),
        "trust_by_role": trust_by_role(scored, role_support),
        "experience_analysis": experience_analysis(scored),
        "quadrant_summary": quadrant_summary(quadrants),
        "paradox_profile": focus_profile(quadrants, slice_support),
    }


# (column, descending) order of each written report; keys break ties.
REPORT_ORDER = {
    "dataset_summary": [],
    "ai_usage_distribution": [("DeveloperCount", True), ("AISelect", False)],
    "trust_by_usage": [("AvgUsageScore", False), ("UsageBand", False)],
    "trust_by_role": [("AvgTrustScore", True), ("DevType", False)],
    "experience_analysis": [("AvgTrustScore", True), ("ExperienceGroup", False)],
    "quadrant_summary": [("DeveloperCount", True), ("TrustUsageGroup", False)],
    "paradox_profile": [("DeveloperCount", True), ("DevType", False), ("Country", False), ("RemoteWork", False)],
}
