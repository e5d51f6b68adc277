"""Datasets behind the charts and the interactive slice."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorelab import vocabulary as V
from scorelab.functions.display import bin_centre, bin_label, fixed_text, percent_text, shorten_role, thousands_text
from scorelab.functions.encode import lookup
from scorelab.functions.hashing import hash_jitter
from scorelab.operators import profiles as P
from scorelab.operators.cells import roll_up
from scorelab.operators.sampling import bounded_sample
from scorelab.operators.segments import dense_grid, density, one_row

USAGE_ORDER = [*V.USAGE_POINTS, V.UNKNOWN]


def usage_labels(distribution: DataFrame, labels: Mapping[str, str] = V.USAGE_LABELS) -> DataFrame:
    """Usage categories relabelled, from least to most active."""
    return P.ordered_by_category(distribution, "AISelect", USAGE_ORDER, ascending=False).select(
        "AISelect", lookup("AISelect", labels).alias("Label"), P.COUNT,
        thousands_text(P.COUNT).alias("CountLabel"),
    )


def band_lines(by_band: DataFrame) -> DataFrame:
    """Trust and frustration along the ordered usage bands."""
    return P.ordered_by_category(by_band, "UsageBand", V.USAGE_BANDS, position="x").select(
        "x", "UsageBand", P.COUNT, "AvgTrustScore", "AvgFrustrationScore",
        fixed_text("AvgTrustScore").alias("TrustLabel"),
        fixed_text("AvgFrustrationScore").alias("FrustrationLabel"),
        thousands_text(P.COUNT).alias("CountLabel"),
    )


def scatter_points(scored: DataFrame, key: str = V.KEY, cap: int = 12000, seed: int = 0,
                   cuts: DataFrame | None = None) -> DataFrame:
    """A bounded sample of usage x trust with a little repeatable jitter."""
    columns = ["UsageScore", "TrustScore", "FrustrationScore"]
    sample = bounded_sample(scored.select(key, *columns).dropna(subset=columns), key, cap, seed)
    points = sample.select(
        key,
        (F.col("UsageScore") + hash_jitter(key, seed + 1)).alias("x"),
        (F.col("TrustScore") + hash_jitter(key, seed + 2)).alias("y"),
        "FrustrationScore",
    )
    if cuts is None:
        return points
    cut = one_row(cuts)
    return points.withColumns({"UsageCut": cut.getField("UsageScore"), "TrustCut": cut.getField("TrustScore")})


def quadrant_sizes(summary: DataFrame, total: DataFrame | None = None) -> DataFrame:
    """Quadrants in declared order with their share of ``total`` or of the view."""
    shared = P.with_share(summary, total=total)
    return P.ordered_by_category(shared, "TrustUsageGroup", V.QUADRANTS).select(
        "TrustUsageGroup", P.COUNT, "Share", percent_text("Share").alias("ShareLabel"),
        thousands_text(P.COUNT).alias("CountLabel"),
    )


def quadrants_by_frustration(summary: DataFrame) -> DataFrame:
    return summary.select("TrustUsageGroup", "AvgFrustrationScore").orderBy("AvgFrustrationScore", "TrustUsageGroup")


def experience_lines(by_experience: DataFrame) -> DataFrame:
    """Trust along career stages, with the spread over all and over known stages."""
    ordered = P.ordered_by_category(by_experience, "ExperienceGroup", V.EXPERIENCE_GROUPS, position="x")
    return ordered.select(
        "x", "ExperienceGroup", lookup("ExperienceGroup", V.EXPERIENCE_SHORT).alias("Label"), P.COUNT, "AvgTrustScore",
        P.spread(by_experience, "AvgTrustScore", "ExperienceGroup", V.UNKNOWN).scalar().alias("KnownSpread"),
        P.spread(by_experience, "AvgTrustScore").scalar().alias("AllSpread"),
    )


def density_points(scored: DataFrame) -> DataFrame:
    """Sparse density with bin centres and labels."""
    return density(scored, "UsageScore", "TrustScore").select(
        "u_bin", "t_bin", "Developers", bin_centre("u_bin").alias("x"), bin_centre("t_bin").alias("y"),
        bin_label("u_bin").alias("UsageBin"), bin_label("t_bin").alias("TrustBin"),
    )


def density_matrix(scored: DataFrame) -> DataFrame:
    return dense_grid(density(scored, "UsageScore", "TrustScore"))


def importance_bars(importance: DataFrame, labels: Mapping[str, str] = V.FEATURE_LABELS) -> DataFrame:
    """Importances as labelled percentages, smallest first, with the caller's labels if given."""
    return importance.orderBy("Importance", F.col("Feature").desc()).select(
        "Feature", lookup("Feature", labels).alias("FeatureLabel"),
        (F.col("Importance") * 100).alias("ImportancePct"),
        percent_text(F.col("Importance") * 100).alias("ImportanceLabel"),
    )


def cluster_points(projected: DataFrame, key: str = V.KEY, cap: int = 9000, seed: int = 0,
                   names: Mapping[int, str] | None = None) -> DataFrame:
    """A bounded sample of the projected rows with the cluster's name."""
    plain = F.concat(F.lit("Cluster "), F.col("Cluster"))
    label = lookup("Cluster", names, otherwise=plain) if names else plain
    return bounded_sample(projected.select(key, "PC1", "PC2", "Cluster"), key, cap, seed).withColumn(
        "ClusterLabel", label
    )


def role_extremes(by_role: DataFrame, bottom: int = 5, top: int = 8, flag_scope: str = "all") -> DataFrame:
    """Lowest and highest roles, flagged against the median of ``all`` roles or of
    the ``selected`` ones."""
    ends = P.extremes(by_role, "DevType", "AvgTrustScore", bottom, top)
    flagged = P.with_median_flag(ends, "AvgTrustScore", by_role if flag_scope == "all" else ends)
    return flagged.select(
        "DevType", shorten_role("DevType").alias("RoleLabel"), P.COUNT, "AvgTrustScore", "AboveMedian",
        fixed_text("AvgTrustScore").alias("TrustLabel"), thousands_text(P.COUNT).alias("CountLabel"),
    )


def _placed(focus: DataFrame) -> DataFrame:
    # The same filter on both sides of the key join lets Spark compute the profile once.
    return focus.where(F.col("Country").isNotNull())


def country_totals(focus: DataFrame, k: int = 8) -> DataFrame:
    totals = _placed(focus).groupBy("Country").agg(F.sum(P.COUNT).alias("Developers"))
    return P.top_k(totals, "Developers", k, ["Country"])


def country_detail(focus: DataFrame, k: int = 8) -> DataFrame:
    """Profile rows of the k largest countries, with a simplified work mode."""
    detail = P.keep_keys(_placed(focus), country_totals(focus, k), "Country")
    return detail.withColumn("WorkMode", lookup("RemoteWork", V.WORK_MODE_LABELS, otherwise="Other"))


def country_work_modes(focus: DataFrame, k: int = 8, skip_absent: bool = False) -> DataFrame:
    """Countries by work mode, in the order of the country totals."""
    table = P.pivot_counts(country_detail(focus, k), "Country", "WorkMode", P.COUNT, V.WORK_MODE_ORDER, skip_absent)
    return table.join(country_totals(focus, k), "Country").orderBy("Developers", F.col("Country").desc()).drop("Developers")


def named_clusters(summary: DataFrame, profiles: Mapping[int, tuple[str, str]]) -> DataFrame:
    """Cluster summary with a caller's name and meaning per cluster id."""
    shown = ["UsageScore", "TrustScore", "FrustrationScore", "AgentDepth", "AIModelCount", "WorkflowIntegration",
             "WorkExpNum"]
    return summary.select(
        "Cluster",
        lookup("Cluster", {i: p[0] for i, p in profiles.items()}, otherwise=V.UNKNOWN).alias("Segment"),
        lookup("Cluster", {i: p[1] for i, p in profiles.items()}, otherwise=V.UNKNOWN).alias("Meaning"),
        P.COUNT, *[F.bround(c, 2).alias(c) for c in shown],
    ).orderBy("Cluster")


def scan_table(scan: DataFrame) -> DataFrame:
    """The k sweep as display text."""
    return scan.select("k", thousands_text("inertia").alias("inertia"), fixed_text("silhouette", 3).alias("silhouette")
                       ).withColumnsRenamed({"k": "Clusters (k)", "inertia": "Inertia", "silhouette": "Silhouette"})


# --- interactive slice: one filtered frame, four aggregates ------------------

def slice_kpis(rows: DataFrame, quadrant: str = V.FOCUS_QUADRANT) -> DataFrame:
    inside = F.count_if(F.col("TrustUsageGroup") == quadrant)
    return rows.agg(
        F.count(F.lit(1)).alias("Developers"),
        inside.alias("FocusDevelopers"),
        F.try_divide(inside * 100.0, F.count(F.lit(1))).alias("FocusShare"),
        F.avg("UsageScore").alias("AvgUsageScore"),
        F.avg("TrustScore").alias("AvgTrustScore"),
        F.avg("FrustrationScore").alias("AvgFrustrationScore"),
    )


_MEANS = {"AvgUsageScore": "UsageScore", "AvgTrustScore": "TrustScore", "AvgFrustrationScore": "FrustrationScore"}


def slice_quadrants(rows: DataFrame) -> DataFrame:
    return quadrant_sizes(P.profile(rows, ["TrustUsageGroup"], _MEANS))


def slice_top_groups(rows: DataFrame, column: str, k: int = 12, quadrant: str = V.FOCUS_QUADRANT) -> DataFrame:
    """The k largest roles or countries of one quadrant, small to large."""
    grouped = P.profile(rows.where(F.col("TrustUsageGroup") == quadrant), [column],
                        {"AvgFrustration": "FrustrationScore"}, count="Developers")
    return P.top_k(grouped, "Developers", k, [column])


def cell_quadrants(cells: DataFrame) -> DataFrame:
    """``slice_quadrants`` from cells."""
    return quadrant_sizes(roll_up(cells, ["TrustUsageGroup"], _MEANS))


def cell_top_groups(cells: DataFrame, column: str, k: int = 12, quadrant: str = V.FOCUS_QUADRANT) -> DataFrame:
    """``slice_top_groups`` from cells."""
    grouped = roll_up(cells.where(F.col("TrustUsageGroup") == quadrant), [column], {"AvgFrustration": "FrustrationScore"}, count="Developers")
    return P.top_k(grouped, "Developers", k, [column])


def filter_options(rows: DataFrame, column: str, k: int = 15) -> DataFrame:
    """The k most frequent values, listed by name."""
    return P.frequencies(rows.where(F.col(column).isNotNull()), column).limit(k).orderBy(column)


def headline(summary: DataFrame, quadrants: DataFrame, roles: DataFrame, experience: DataFrame,
             quadrant: str = V.FOCUS_QUADRANT) -> DataFrame:
    """One row: totals, the focus quadrant's size and share, extreme roles, spread."""
    focus = quadrants.where(F.col("TrustUsageGroup") == quadrant).agg(F.sum(P.COUNT)).scalar()
    ends = one_row(P.extreme_rows(roles, "DevType", "AvgTrustScore"))
    known_spread = P.spread(experience, "AvgTrustScore", "ExperienceGroup", V.UNKNOWN).scalar()
    return summary.select(
        *summary.columns,
        focus.alias("FocusCount"),
        F.try_divide(focus * F.lit(100.0), F.col("RespondentsWithTrust")).alias("FocusShare"),
        *[ends.getField(c).alias(c) for c in ("HighestKey", "HighestValue", "LowestKey", "LowestValue")],
        known_spread.alias("ExperienceSpread"),
    )


def slice_of(quadrants: DataFrame, roles: Sequence[str] = (), countries: Sequence[str] = (),
             years: tuple[float | None, float | None] = (None, None), keep_unknown_years: bool = True) -> DataFrame:
    return P.slice_rows(quadrants, {"DevType": roles, "Country": countries}, years,
                        keep_unknown_years=keep_unknown_years)
