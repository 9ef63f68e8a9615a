"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from fleetlens.catalog import all_queries
from fleetlens.session import local_session

HEADLINE = (
    "daily_kpi", "silver_table", "turbine_health", "dedup_readings", "bronze_incremental", "training_dataset",
    "failure_labels", "feature_table", "rolling_time", "operating_hours", "failure_episodes", "maintenance_interval_join",
    "temporal_split", "roc_auc", "champion_selection", "ks_statistic", "data_drift", "concept_drift", "prediction_drift",
    "quality_profile", "dataset_profile",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, shuffle_partitions=8, name="bench")
    spark.sparkContext.setLogLevel("ERROR")
    queries, seconds = all_queries(), {}
    spark.read.parquet(f"{folder}/events.parquet").count()
    for name in HEADLINE:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
