"""Times the headline queries; prints one JSON line."""

import json
import os
import time

from pyspark.sql import SparkSession

from quadrille.plans import catalogue

NAMES = ["sum_by_flag", "avg_by_flag", "min_max_by_flag", "value_join", "star_pattern", "basic_pattern", "distinct_values", "top_k", "filter_by_value", "string_functions", "window_sum"]


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = SparkSession.builder.master(f"local[{cpus}]").config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", cpus).config("spark.sql.session.timeZone", "UTC").config("spark.python.sql.dataFrameDebugging.enabled", "false").getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    took = {}
    for name in NAMES:
        began = time.time()
        catalogue.queries()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "headline_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
