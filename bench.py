"""Times the headline queries and prints one JSON line.

Each query runs once to warm up and then ``BENCH_RUNS`` times; the best run counts. Results are
computed in full and thrown away, so driver-side conversion is not measured.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from temblor.plans.registry import QUERIES
from temblor.session import SETTINGS, TUNING

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))

HEADLINE = [
    "raw_to_country_risk",
    "country_risk_top10",
    "clean_emsc",
    "clean_usgs",
    "dedup_events",
    "describe_features",
    "feature_stats",
    "monthly_trend_mag",
    "top_regions_profile",
    "hazard_distribution",
    "correlation_matrix",
    "histogram_mag",
    "kde_mag",
    "undersample_country",
    "map_sample",
    "standardised_physical5",
    "silhouette_rule",
    "kmeans_spatial",
    "kmeans_hazard",
    "bisecting_hazard",
    "gmm_physical5",
    "elbow_hazard",
    "model_metrics",
    "country_risk_clusters",
    "raw_table",
    "clean_table",
    "model_comparison",
    "eda_summary",
    "kmeans_physical5",
]


def session() -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("temblor-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", CPUS)
    )
    for name, value in {**SETTINGS, **TUNING}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(spark: SparkSession, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = session()
    times = {}
    for name in HEADLINE:
        run(spark, name)
        times[name] = round(min(run(spark, name) for _ in range(RUNS)), 3)
        print(f"{name:28s} {times[name]:8.3f}", file=sys.stderr, flush=True)
    spark.stop()
    scale = re.search(r"sf([0-9.]+)", SF_DIR)
    print(
        json.dumps(
            {
                "metric": "total seconds of headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )


if __name__ == "__main__":
    main()
