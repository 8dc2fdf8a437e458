"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local threads), BENCH_QUERIES (names, or ``all``).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cellstride import catalog  # noqa: E402
from cellstride.session import build_session  # noqa: E402

HEADLINE = [
    "flagship", "downsample_2min", "row_lags", "time_lags", "sampling_check", "train_val_split", "impute_mean",
    "impute_time", "missing_runs", "cap_by_area", "scale_standard", "scale_robust", "scale_by_area", "examples",
    "lag_stats", "cyclical_p", "stat_table", "acf", "pacf", "pearson_matrix", "dcor_matrix", "kde_curve",
    "scatter_bins", "pca_variance", "metrics_overall", "fit_score_linear", "fit_score_gbt", "prepare_job",
    "downsample_stream", "csv_scan_double", "parquet_by_series",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(catalog.QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = build_session("cellstride-bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
                          spark__driver__memory="16g", spark__ui__enabled="false",
                          spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    catalog.QUERIES["flagship"](spark, sf).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf.rstrip("/"))}))


if __name__ == "__main__":
    main()
