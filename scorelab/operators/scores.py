"""Component columns and 0-100 composite scores."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorelab import vocabulary as V
from scorelab.functions.encode import (
    all_present,
    capped,
    multiselect_count,
    named,
    ordinal,
    weighted_sum_capped,
)


@dataclass(frozen=True)
class Component:
    """One score input, rescaled to 0-1 as ``(value - offset) / divisor``."""

    column: str
    divisor: float
    offset: int = 0

    def scaled(self) -> Column:
        value = named(self.column)
        if self.offset:
            value = value - F.lit(self.offset)
        return value / F.lit(self.divisor)


@dataclass(frozen=True)
class ScoreSpec:
    """Mean of the components times 100.

    Components are added in declared order: cut points are often values that
    many rows share, so the last float digit decides on which side they fall.
    ``require_all`` makes the score null unless every component is known.
    """

    name: str
    components: tuple[Component, ...]
    require_all: bool = False


USAGE = ScoreSpec(
    "UsageScore",
    (
        Component("UsageFreq", 5.0),
        Component("AgentDepth", 5.0),
        Component("AIModelCountCapped", 10.0),
        Component("WorkflowIntegration", 10.0),
    ),
)
TRUST = ScoreSpec(
    "TrustScore",
    (
        Component("TrustAcc", 4.0, offset=1),
        Component("TrustComplex", 4.0, offset=1),
        Component("Sentiment", 4.0, offset=1),
    ),
    require_all=True,
)
FRUSTRATION = ScoreSpec(
    "FrustrationScore",
    (Component("ProblemCountCapped", 5.0), Component("ThreatLevel", 1.0)),
)
SCORES = (USAGE, TRUST, FRUSTRATION)


def composite(spec: ScoreSpec) -> Column:
    total = reduce(lambda a, b: a + b, [c.scaled() for c in spec.components])
    score = total / F.lit(float(len(spec.components))) * F.lit(100.0)
    if spec.require_all:
        score = F.when(all_present([c.column for c in spec.components]), score)
    return score


def add_components(df: DataFrame) -> DataFrame:
    """Answers to numbers: two levels of columns, both narrow."""
    encoded = df.withColumns(
        {
            "UsageFreq": ordinal("AISelect", V.USAGE_POINTS, default=0),
            "AgentDepth": ordinal("AIAgents", V.AGENT_POINTS, default=0),
            "AIModelCount": multiselect_count("AIModelsHaveWorkedWith"),
            "TasksMostlyAI": multiselect_count("AIToolCurrently mostly AI"),
            "TasksPartiallyAI": multiselect_count("AIToolCurrently partially AI"),
            "TrustAcc": ordinal("AIAcc", V.ACCURACY_POINTS, default=None),
            "TrustComplex": ordinal("AIComplex", V.COMPLEX_POINTS, default=None),
            "Sentiment": ordinal("AISent", V.SENTIMENT_POINTS, default=None),
            "ProblemCount": multiselect_count(
                "AIFrustration", exclude=V.NOT_A_PROBLEM, empty_values=[V.NO_PROBLEMS_GIVEN]
            ),
            "ThreatLevel": ordinal("AIThreat", V.THREAT_POINTS, default=0.0),
            "DevEnvToolCount": multiselect_count("DevEnvsHaveWorkedWith"),
        }
    )
    return encoded.withColumns(
        {
            "AIModelCountCapped": capped("AIModelCount", V.MODEL_CAP),
            "WorkflowIntegration": weighted_sum_capped(
                "TasksMostlyAI", "TasksPartiallyAI", V.PARTIAL_TASK_WEIGHT, V.WORKFLOW_CAP
            ),
            "ProblemCountCapped": capped("ProblemCount", V.PROBLEM_CAP),
        }
    )


def add_scores(df: DataFrame, specs: tuple[ScoreSpec, ...] = SCORES) -> DataFrame:
    return df.withColumns({spec.name: composite(spec) for spec in specs})


def score_responses(df: DataFrame) -> DataFrame:
    """Cleaned table to scored table, without a shuffle."""
    return add_scores(add_components(df))
