"""Times the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from forkwise.plans.queries import QUERIES

HEADLINE = ["account_history", "storage_history", "canonical_receipts", "revert_ops", "commit_fold", "apply_revert", "cursor_timeline", "slot_block_index", "inv_index_parity", "receipts_root"]


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    took = {}
    QUERIES["active_block_count"](spark, sf_dir).collect()
    for name in HEADLINE:
        began = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({"metric": "total time of the headline queries", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": sf_dir.rstrip("/").rpartition("sf")[2]}))
    spark.stop()


if __name__ == "__main__":
    main()
