"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR   folder of the parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default: all)
BENCH_QUERIES  comma-separated names, to run a part
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = {
    "drop_duplicate_keys": "drop_duplicate_keys",
    "impute_normalize": "impute_normalize",
    "vif_select": "vif_select",
    "linear_workflow": "linear_workflow",
    "logistic_workflow": "logistic_workflow",
    "eval_metrics": "eval_metrics",
    "group_cumulative_split": "group_cumulative_split",
    "assemble_features": "assemble_features",
    "gbt_grid_search": "gbt_grid_search",
    "roc_curve": "roc_curve",
    "roc_auc": "roc_auc",
    "match_nearest": "match_nearest",
}


def main() -> None:
    from pyspark.sql import SparkSession

    from gradus.queries import QUERIES

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("bench")
    settings = {
        "spark.ui.enabled": "false",
        "spark.driver.memory": "6g",
        "spark.sql.shuffle.partitions": cpus,
        "spark.python.worker.reuse": "true",
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    wanted = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or list(HEADLINE.values())
    spark.range(1000).selectExpr("sum(id)").collect()
    took = {}
    for name in wanted:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - start, 3)
        spark.catalog.clearCache()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
