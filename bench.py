"""Benchmark: the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query runs to completion through the ``noop`` sink (every row is
computed, nothing is collected to the driver).  A warm-up pass over the
smallest tables first loads the JVM and the generated code, so the timed
pass measures steady-state execution.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

from kestrel.plans import workloads  # noqa: E402
from kestrel.session import build_session  # noqa: E402

HEADLINE = [
    "trip_mapreduce",          # text scan, header skip, fail-fast parse, floor 6
    "trip_pig",                # null-permissive parse, SUM/COUNT
    "trip_sql",                # drop-malformed parse, float AVG via spark.sql
    "bucket_mean",             # typed columns, rounding, bounds
    "simple_mean",             # parse + mean per key
    "equi_join_keyed",         # large x dimension join
    "equi_join_large",         # large x large join
    "block_add_outer",         # union + cell sum + dense blocks + text
    "block_add_inner",
    "propagate_5",             # 5 rounds of label propagation, symmetric graph
    "component_sizes_directed",
]


def _sf_of(path: str) -> float | str:
    m = re.search(r"sf([0-9.]+)", path)
    return float(m.group(1)) if m else path


def _run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    df = workloads.REGISTRY[name].run(spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    spark = build_session(
        master=f"local[{cpus}]", app="kestrel-bench",
        shuffle_partitions=max(2 * int(cpus), 8),
        conf={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
              "spark.sql.files.maxPartitionBytes": str(32 * 1024 * 1024),
              # each bench table is one row group, which one task would read alone
              "kestrel.scan.partitions": cpus})
    if warm_dir and os.path.isdir(warm_dir):
        for name in names:
            _run(spark, name, warm_dir)
    times = {name: round(_run(spark, name, sf_dir), 3) for name in names}
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_sec", "value": total, "unit": "sec",
                      "queries": times, "sf": _sf_of(sf_dir), "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
