"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` picks the tables, ``BENCH_CPUS`` the local cores.  The scored
stage is timed on its own; reports then read it, as separate jobs would.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalog import frames
from catalog.registry import QUERIES
from scorelab.session import local_session

HEADLINE = [
    "clean_responses", "composite_score", "dedupe_by_key", "csv_roundtrip",
    "dataset_summary", "category_distribution", "usage_band_profile", "role_profile",
    "experience_profile", "quadrant_summary", "segment_profile",
    "ordered_categories", "band_lines", "scatter_points", "quadrant_sizes", "quadrants_by_frustration",
    "experience_lines", "density_points", "top_groups_detail", "filter_options", "filtered_quadrants",
    "median_cut_many_values", "hist2d_dense", "role_extremes", "country_work_modes", "headline_kpis",
    "filtered_kpis", "filtered_top_groups", "bounded_sample", "stratified_split", "pivot_counts",
    "classification_report", "roc_auc", "quality_report", "standardize", "silhouette_sampled",
    "kmeans_assign", "kmeans_scan", "pca_project", "rf_ensemble",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/orders.parquet").count()  # start the JVM's reader once

    seconds: dict[str, float] = {}

    def timed(name, action) -> None:
        start = time.perf_counter()
        action()
        seconds[name] = round(time.perf_counter() - start, 3)

    timed("score_stage", lambda: frames.scored_table(spark, sf_dir))
    for name in HEADLINE:
        timed(name, lambda: run(QUERIES[name](spark, sf_dir)))
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
