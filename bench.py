"""Times headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from basketry.plans.registry import QUERIES
from basketry.session import session

HEADLINE = ["headline_index", "store_balanced_classes", "imputed_prices", "jevons_by_class", "clean_prices", "classification_ladder", "v_monitor_price_alerts", "fct_daily_prices", "tree_roll_up", "matching_ladder", "nearest_vectors", "fx_as_of"]


def main() -> None:
    folder, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = session("bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    small = os.path.join(os.path.dirname(folder.rstrip("/")), "sf0.001")
    QUERIES["headline_index"][0](spark, small if os.path.isdir(small) else folder).write.format("noop").mode("overwrite").save()  # a warm JVM, as the baseline had; on other files
    took = {}
    for name in HEADLINE:
        began = time.perf_counter()
        QUERIES[name][0](spark, folder).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
