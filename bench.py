"""Times the headline queries: one warm-up, then the median of three runs into the noop sink.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from cindergrid.plans.testbed_queries import QUERIES  # noqa: E402
from cindergrid.session import build_session  # noqa: E402

HEADLINE = [
    "fact_cloud_carbon", "carbon_trends", "q_cloud", "q_cloud_summary", "d_scope_breakdown",
    "d_dc_emissions", "fact_grid_intensity", "grid_intensity_daily", "dim_grid_regions",
    "q_grid_current", "d_by_category", "datacenter_with_grid", "merge_upsert",
    "ingest_grid_history", "dq_unique", "lookback_window", "incremental_since", "stream_upsert",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        runs = []
        for attempt in range(4):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if attempt:
                runs.append(time.perf_counter() - start)
        times[name] = round(statistics.median(runs), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
