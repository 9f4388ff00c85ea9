"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local threads. Every query runs in
full (all rows and columns are produced and dropped). The first round of each query warms
the JVM and is not counted; of ``BENCH_ROUNDS`` further rounds the best one is.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lotwise.session import build_session  # noqa: E402
from verification.queries import queries  # noqa: E402

HEADLINE = [
    "s3_page_json",
    "s4_s5_offers",
    "s7_typed_node",
    "s10_first_seen",
    "s11_rates",
    "k3_compact",
    "l3_pending_rows",
    "l4_ledger",
    "t3_stg_rates",
    "t5_t7_normalized",
    "m1_fct",
    "m2_latest",
    "m4_dim",
    "m5_daily",
    "m6_brand",
    "r1_brand_share",
    "r8_overview",
    "r9_mileage",
    "r10_distribution",
    "q6_latest_offers",
    "q7_bands",
    "q8_vehicles",
    "d3_digest",
    "d4_digest",
    "c4_relationships",
]
ROUNDS = int(os.environ.get("BENCH_ROUNDS", "1"))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        int(cpus) if cpus.isdigit() else 8,
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    built, seconds = queries(), {}
    for name in sys.argv[1:] or HEADLINE:
        times = []
        for _ in range(ROUNDS + 1):
            start = time.perf_counter()
            built[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times[1:]), 3)
        print(f"{name:20} first {times[0]:7.2f}  best {seconds[name]:7.2f}", file=sys.stderr, flush=True)
    spark.stop()
    line = {
        "metric": "headline queries, total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
