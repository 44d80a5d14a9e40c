"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR   folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS     local threads (default 8)
BENCH_PLAIN=1  also times the plain forms that the rewritten operators replace; those that are
               quadratic, and their rewritten forms, on the tables of BENCH_SMALL_DIR
"""

from __future__ import annotations

import json
import os
import sys
import time

from tidemark import catalog
from tidemark.catalog.plain import PLAIN, QUADRATIC, plain_frame
from tidemark.session import build_session

HEADLINE = (
    "job_kpis_by_color",
    "scd2_with_deletes",
    "scd2_change_metrics",
    "record_snapshots",
    "charges_to_date",
    "dated_fact_lookup",
    "dated_code_lookup",
    "latest_row_per_key",
    "or_key_join",
    "missing_work_anti",
    "requeue_recent",
    "diagnosis_counters",
    "charge_counters",
    "classify_tiers",
    "compress_history",
    "pivot_sparse_rows",
    "history_load_full",
)


def run(frame) -> float:
    """Seconds to build and run one query; every row is computed, none is collected."""
    begun = time.perf_counter()
    frame().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - begun, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()

    def best(name: str, frame) -> float:
        took = min(run(frame), run(frame))
        print(name, took, file=sys.stderr, flush=True)
        return took

    times = {n: best(n, lambda: queries[n](spark, folder)) for n in HEADLINE}
    line = {
        "metric": "headline queries, best of two runs each",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    if os.environ.get("BENCH_PLAIN"):
        line["plain"] = {
            n: best(f"plain {n}", lambda: plain_frame(n, spark, folder))
            for n in PLAIN
            if n not in QUADRATIC
        }
        small = os.environ.get("BENCH_SMALL_DIR", "/root/testdata/sf0.01")
        line["small"] = {
            n: {
                "rewritten": best(f"small {n}", lambda: queries[n](spark, small)),
                "plain": best(f"small plain {n}", lambda: plain_frame(n, spark, small)),
            }
            for n in QUADRATIC
        }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
