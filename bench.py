"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8) and
BENCH_RUNS (default 3, the median counts, after one warm-up) set the run;
a query whose warm-up takes more than SLOW seconds is measured once. Names on
the command line replace the headline list; ``all`` stands for every query.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import Observation
from pyspark.sql import functions as F

from skyledger.plans.queries import QUERIES
from skyledger.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
SLOW = 3.0

HEADLINE = [
    "rename_project",
    "csv_by_name",
    "silver_flights",
    "gold_monthly",
    "gold_airline_month",
    "parse_json",
    "clean_tracking",
    "delay_correction",
    "latest_state",
    "latest_state_by_max",
    "latest_state_enriched",
    "active_enriched",
    "bi_total",
    "bi_passengers_month",
    "bi_flights_month",
    "bi_filter_options_month",
    "bi_summary",
    "batch_chain",
    "stream_bronze",
    "stream_silver",
    "stream_gold",
    "stream_gold_active",
    "stream_current",
    "stream_current_log",
    "operational_state",
    "generate_flights",
    "generate_events",
]


def run_once(spark, name: str) -> tuple[float, int]:
    """Seconds to build the query and produce every row of its result, and the
    number of rows. Stages a query runs before its result (files, tables,
    streams) are included."""
    start = time.perf_counter()
    seen = Observation()
    result = QUERIES[name](spark, SF_DIR).observe(seen, F.count(F.lit(1)).alias("rows"))
    result.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start, seen.get["rows"]


def main() -> None:
    spark = build_session(
        "bench",
        master=f"local[{CPUS}]",
        shuffle_partitions=CPUS,
        conf={"spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    seconds, rows = {}, {}
    for name in QUERIES if names == ["all"] else names:
        warm_up, rows[name] = run_once(spark, name)
        runs = RUNS if warm_up < SLOW else 1
        seconds[name] = round(statistics.median(run_once(spark, name)[0] for _ in range(runs)), 3)
    result = {
        "metric": "sum of median query times",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "rows": rows,
        "sf": Path(SF_DIR).name.removeprefix("sf"),
        "cpus": CPUS,
        "runs": RUNS,
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
