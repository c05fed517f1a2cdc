"""Time the headline queries on one machine; prints one JSON line.

Each query runs twice, models once; the better time counts, so that it is the query and not the
compilation of a fresh JVM that is measured.

BENCH_SF_DIR names the folder with the Parquet tables, BENCH_CPUS the cores, BENCH_QUERIES
an optional comma-separated choice of queries.
"""

from __future__ import annotations

import json
import os
import time

from tabloom.catalog import QUERIES
from tabloom.session import local_session

# The day rank (first) is the one query for which the baseline has a number at this size (600 000 rows).
HEADLINE = [
    "dense_rank_date", "dense_rank_year_month", "join_left", "null_profile", "row_null_counts", "value_counts_normalized",
    "describe", "describe_by_class", "skew_profile", "quantiles", "filter_range_quantile", "histogram", "box_stats",
    "corr_pairs", "dedup_keep_first", "count_of_counts", "key_overlap", "global_row_index", "top_k", "impute_mean",
    "rare_to_others", "label_encode", "zscore", "skew_log_transform", "narrow_types", "anova_oneway", "ttest_independent",
    "ks_histogram_numeric", "ks_histogram_categorical", "trend_slope", "split_random", "split_stratified",
    "split_time_series", "split_group_kfold", "sample_under", "sample_over", "auc_roc", "f1_scores", "prepared_features",
    "gbt_train_time_cv",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    chosen = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    spark = local_session(cpus, partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    # Start the executors and compile the first stages before anything is timed.
    QUERIES["split_random"](spark, folder).count()
    times = {}
    for name in chosen:
        runs = []
        for _ in range(1 if name.startswith("gbt") else 2):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(min(runs), 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": scale}))


if __name__ == "__main__":
    main()
