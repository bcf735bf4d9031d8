"""Times of the headline queries, as one JSON line."""

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from obsmill import queries as q

NAMES = ("V13_two_part", "V15_multi_part", "V33_usability", "G18_completeness", "G22_station_years", "G23_distribution", "G12_nested_strategy", "G10_best_hour_strategy", "W01_missing_runs", "W02_inventory")


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.local.dir", folder).config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    took = {}
    for name in ("G22_station_years", *NAMES):  # the first run only warms up
        began = time.time()
        q.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
