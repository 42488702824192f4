"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is executed to completion with the no-op sink (full computation, no
driver collect).  What earlier queries have persisted is dropped before each
one, so every query pays for reading and joining its source tables.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from salesplane.plans import base  # noqa: E402
from salesplane.plans.catalog import load_all  # noqa: E402
from salesplane.plans.pipeline import engineer_all  # noqa: E402
from salesplane.session import get_spark  # noqa: E402
from salesplane.sources.tpch import sales_from_tpch  # noqa: E402

HEADLINE = ["flagship_share_trend", "w3_rolling_stats", "w6_momentum", "w12_yoy", "w17_spikes",
            "c8_calendar_on_sales", "a1_store_behaviour", "a2_brand_analysis", "a10_performance_categories",
            "a13_store_quality", "a21_platform_preference", "a25_platform_tenure", "a29_store_rank_in_brand_platform"]


def timed(spark, build):
    base.forget(spark)
    t0 = time.time()
    build().write.format("noop").mode("overwrite").save()
    return round(time.time() - t0, 3)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(f"local[{cpus}]", int(cpus))
    queries, _ = load_all()
    times = {}
    for name in HEADLINE:
        times[name] = timed(spark, lambda: queries[name](spark, sf_dir))
    times["engineer_all_features"] = timed(spark, lambda: engineer_all(sales_from_tpch(spark, sf_dir)))
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_wall_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
