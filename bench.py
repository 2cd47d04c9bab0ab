"""Time the headline queries and print one JSON line.

Each query runs to completion into a no-op sink, so every result row is computed and none is
collected.  A first run compiles the generated code; the second, planning included, is timed.  ``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores,
``BENCH_QUERIES`` an optional comma-separated choice.
"""

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "a22_transition_fee", "w1_brand_order", "w3_delta_prices", "w4_strongest_record",
    "w6_unique_published_names", "w12_best_flight_direct_first", "j5_match_brands", "j6_fill_rights",
    "j8_top_up", "j9_fill_across_dates", "j10_season_pair_preferences", "a4_strongest_status",
    "a6_unit_completeness", "a23_market_position", "a26_rights_gained", "a27_geographic_drill",
    "f4_pretty_name", "f9_parse_price", "f16_rule_lines", "j16_merge_changes", "t3_strongest_per_unit",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "16g")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
             .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))  # one machine: its own folder is the shared one
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from stairfare.catalog import all_queries
    qs = all_queries()
    wanted = os.environ.get("BENCH_QUERIES")
    chosen = wanted.split(",") if wanted else HEADLINE
    qs["a29_distinct_counts"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # JVM warm-up
    times = {}
    for name in chosen:
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
