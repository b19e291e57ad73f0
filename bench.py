"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR  data folder (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_QUERIES comma-separated names; "all" for every registered query
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from dealtide.checks.queries import QUERIES  # noqa: E402
from dealtide.session import build_session  # noqa: E402

HEADLINE = (
    "dim_lead", "dim_date", "fact_sales", "star_join", "sales_summary_normalized", "sales_summary",
    "region_summary", "performance", "funnel", "monthly_trends", "lead_scoring", "kpi_summary",
    "top_performers", "regional", "funnel_stage", "trend_rollup", "lead_insights", "segment_analysis",
    "exec_summary", "declarative_silver", "dq_report", "dq_quarantine", "merge_upsert",
    "merge_by_partition", "append_increment", "incremental_gold", "stream_available_now",
    "csv_roundtrip", "parquet_partitioned", "run_state",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else list(HEADLINE)
    spark = build_session(
        "dealtide-bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="16g",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="dealtide-bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    # first use of joins, aggregates and writers compiles and loads them
    QUERIES["sales_summary"](spark, folder).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    scale = Path(folder).name.removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )


if __name__ == "__main__":
    main()
