"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores,
BENCH_REPEATS how often each query runs (the best time counts).
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from granary.testbed import load_all  # noqa: E402

HEADLINE = (
    "gold_features",
    "yearly_features",
    "yearly_features_large_dim",
    "silver_measurements",
    "silver_facts",
    "validate_silver",
    "impute_group_mean",
    "clean_numeric_comma",
    "parse_date_dmy",
    "dedupe_exact",
    "reconcile_keys",
    "describe_numeric",
    "correlation_matrix",
    "histogram_density",
    "linear_trend",
    "growth_rate",
    "prediction_table",
    "model_comparison",
    "error_by_range",
    "error_by_category_detail",
    "error_distribution",
    "error_bands",
    "worst_predictions",
    "synthetic_target_noisy",
    "union_real_synthetic",
    "split_train_test",
    "feature_preparation",
    "linreg_elastic",
    "rf_metrics",
    "gbt_metrics",
    "report_table",
)


LONG = 20.0


def run_whole(df: DataFrame) -> None:
    """Compute every row and column without keeping them."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("granary-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "4g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = load_all()
    run_whole(known["value_counts"].run(spark, folder))  # start the executors
    seconds = {}
    for name in HEADLINE:
        times = []
        while len(times) < repeats and sum(times) < LONG:  # a long query counts as it runs the first time
            start = time.perf_counter()
            run_whole(known[name].run(spark, folder))
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times), 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
