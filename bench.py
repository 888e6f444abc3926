"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from measurekit.plans import registry
from measurekit.session import build_session

HEADLINE = [
    "SCL_clean_students",
    "SET1_dedupe",
    "PRF1_profile",
    "AGG21_validation",
    "AGG4_record_summary",
    "AGG5_summary_diff",
    "AGG9_replicate_statistics",
    "AGG9_replicates_per_order",
    "AGG14_fit_metrics",
    "PRF2_describe",
    "WIN1_rolling_mean",
    "FLT6_ml_ready_table",
    "SPL1_shuffle_split",
    "SPL2_stratified_split",
    "SCL17_label_encode",
    "SCL20_standardize",
    "MET1_regression",
    "MET3_binary_metrics",
    "MET6_averages",
    "MDL3_linear_descent",
    "MDL4_least_squares",
    "MDL6_logistic_descent",
    "MDL8_kmeans_two_steps",
    "MDL9_knn_classifier",
    "MET8_silhouette",
    "MET8_squared_silhouette",
    "CHT8_probability_histogram",
    "SRC1_read_submissions",
    "SRC1_read_line_breaks",
    "MDL7_multinomial_on_one_feature",
    "MDL10_tree_on_one_feature",
    "MDL11_forest_on_one_feature",
    "MDL13_regressors_on_one_feature",
    "MDL14_saved_model_scoring",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session("bench", os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    registry.load_all()
    # one small query starts the executors before the clock runs
    registry.QUERIES["AGG6_value_counts"](spark, folder).collect()
    wanted = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in wanted:
        start = time.perf_counter()
        registry.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(folder.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
