"""The stages from export to reports.  Tables on disk couple them, so each stage
can run as its own job and a failed one restarts from its predecessor's table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from scorelab import vocabulary as V
from scorelab.operators.classify import save_ensemble
from scorelab.operators.clean import clean_responses
from scorelab.operators.clustering import best_kmeans, cluster_summary, kmeans_scan
from scorelab.operators.deep_forest import DeepEnsemble, save_deep_ensemble
from scorelab.operators.scores import score_responses
from scorelab.operators.segments import add_quadrants
from scorelab.plans.models import Evaluated, classify, cluster_vectors, segment
from scorelab.plans.reports import REPORT_ORDER, all_reports
from scorelab.session import materialise
from scorelab.sources import read_split_csv, read_survey_csv, read_table, write_metrics, write_report, write_table

CLEANED = "cleaned_data/cleaned_survey_data"
SCORED = "cleaned_data/ai_trust_scores"
QUADRANT_ROWS = "cleaned_data/ai_trust_quadrants"
REPORTS = "spark_sql_results"
MODELS = "ml_results"


def ingest(spark: SparkSession, csv_path: str, out: str, multi_line: bool = True, split: bool = False) -> DataFrame:
    """Export to cleaned table.  ``split`` reads one large file with line breaks in answers by ranges."""
    raw = read_split_csv(spark, csv_path) if split else read_survey_csv(spark, csv_path, multi_line=multi_line)
    write_table(clean_responses(raw), f"{out}/{CLEANED}")
    return read_table(spark, f"{out}/{CLEANED}")


def score(spark: SparkSession, out: str) -> DataFrame:
    """Cleaned table to scored table."""
    write_table(score_responses(read_table(spark, f"{out}/{CLEANED}")), f"{out}/{SCORED}")
    return read_table(spark, f"{out}/{SCORED}")


def report(spark: SparkSession, out: str, exact: bool = True, role_support: int = 100, slice_support: int = 20
           ) -> dict[str, DataFrame]:
    """Scored table to quadrant rows and the seven reports."""
    scored = read_table(spark, f"{out}/{SCORED}")
    write_table(add_quadrants(scored, exact=exact), f"{out}/{QUADRANT_ROWS}")
    quadrants = read_table(spark, f"{out}/{QUADRANT_ROWS}")
    reports = all_reports(scored, quadrants, role_support, slice_support)
    for name, frame in reports.items():
        write_report(frame, f"{out}/{REPORTS}/{name}", order_by=REPORT_ORDER[name])
    return reports


def model(spark: SparkSession, out: str, k: int = 4, starts: int = 10, trees: int = 200, depth: int | None = None,
          ks: Sequence[int] = (2, 3, 4, 5, 6)) -> Evaluated:
    """Scored table to k scan, clusters, ensemble predictions and metrics; trees are unlimited without ``depth``."""
    scored = read_table(spark, f"{out}/{SCORED}")
    vectors = materialise(cluster_vectors(scored), "vectors")
    # Every k and start is fitted once; the scan and the final clusters share the models.
    fitted = best_kmeans(vectors, V.KEY, sorted({*ks, k}), starts=starts)
    scan = kmeans_scan(vectors, V.KEY, ks, models=fitted)
    write_report(scan, f"{out}/{MODELS}/kmeans_scan", order_by=[("k", False)])
    clusters = segment(vectors, k, fitted=fitted).drop("features")
    write_table(clusters, f"{out}/{MODELS}/cluster_rows")
    summary = cluster_summary(read_table(spark, f"{out}/{MODELS}/cluster_rows"), V.CLUSTER_FEATURES)
    write_report(summary, f"{out}/{MODELS}/cluster_summary", order_by=[("Cluster", False)])
    result = classify(scored, trees=trees, depth=depth)
    save = save_deep_ensemble if isinstance(result.ensemble, DeepEnsemble) else save_ensemble
    save(result.ensemble, f"{out}/{MODELS}/rf_ensemble")
    write_report(result.importance, f"{out}/{MODELS}/paradox_feature_importance", order_by=[("Importance", True)])
    write_table(result.predictions, f"{out}/{MODELS}/rf_predictions")
    write_metrics(result.record, f"{out}/{MODELS}/rf_metrics")
    return result
