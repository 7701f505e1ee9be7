"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from waymark.plans.queries import QUERIES

NAMES = ("d3_change_events_window", "d3_change_events_join", "workload_xml_to_events", "j9_j13_convert_events", "j1_j2_split_situations", "a1_snapshot_volume", "a2_event_volume", "q6_latest_per_source", "x3_zip_by_position")


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="waymark-bench-")).getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    took = {}
    for name in NAMES:
        began = time.time()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
