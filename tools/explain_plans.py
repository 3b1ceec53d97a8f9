"""Write the physical plans of the headline queries to PLANS.md.

Usage: python tools/explain_plans.py [sf_dir]
Each query is run once (so AQE shows its final plan), then its formatted
plan is trimmed to the operator tree plus scan, exchange and join details.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kestrel.plans import workloads  # noqa: E402
from kestrel.session import build_session  # noqa: E402

QUERIES = ["trip_mapreduce", "bucket_mean", "equi_join_keyed", "equi_join_large",
           "block_add_outer", "block_pick"]
KEEP = ("Scan", "PushedFilters", "ReadSchema", "Bucketed", "SelectedBucketsCount", "Arguments: hash",
        "Arguments: range", "Join type", "Keys", "Functions", "Condition")


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session(master="local[4]", shuffle_partitions=8)
    out = ["# Physical plans of the headline queries", "",
           f"Generated by `tools/explain_plans.py` at `{sf}` on local[4] (final AQE plans).", ""]
    for name in QUERIES:
        df = workloads.REGISTRY[name].run(spark, sf)
        df.write.format("noop").mode("overwrite").save()
        text = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        tree, details = text.split("\n\n\n", 1) if "\n\n\n" in text else (text, "")
        kept = [ln for ln in details.splitlines()
                if ln.startswith("(") or any(ln.startswith(k) for k in KEEP)]
        out += [f"## {name}", "", "```", tree.strip(), "", *kept, "```", ""]
    # One round of label propagation, as planned inside propagate_min.
    from kestrel.operators.graph import propagate_min
    from kestrel.sources.adjacency import read_adjacency
    seen = {}

    def keep_round(r, df):
        if r == 2:
            df.write.format("noop").mode("overwrite").save()
            seen["plan"] = df._jdf.queryExecution().explainString(
                spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))

    propagate_min(read_adjacency(workloads.symmetric_lines(spark, sf)), rounds=2, on_round=keep_round)
    tree, details = seen["plan"].split("\n\n\n", 1)
    kept = [ln for ln in details.splitlines() if ln.startswith("(") or any(ln.startswith(k) for k in KEEP)]
    out += ["## propagate_min, round 2 (symmetric lineitem graph)", "", "```", tree.strip(), "", *kept, "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
