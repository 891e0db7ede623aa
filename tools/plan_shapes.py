"""Plan shape of every warehouse query as it would run at scale (no automatic broadcasts).

usage: python tools/plan_shapes.py [sf_dir]  -> a markdown table on stdout

Counts come from the physical plan before AQE's runtime changes: hash shuffles
(with their keys), single-partition exchanges, broadcasts, file scans and window
operators.  AQE may still coalesce partitions or split skewed ones at runtime.
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillroll.plans.catalog import QUERIES  # noqa: E402
from tillroll.session import get_spark  # noqa: E402


def shape(plan: str) -> dict:
    own = [ln for ln in plan.split("\n") if "ReusedExchange" not in ln]  # a reused exchange runs once
    text = "\n".join(own)
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*?), \d+\)", text)
    keys = [re.sub(r"#\d+L?", "", k) for k in keys]
    return {
        "hash": len(keys),
        "keys": Counter(keys),
        "reused": plan.count("ReusedExchange"),
        "single": text.count("Exchange SinglePartition"),
        "range": text.count("Exchange rangepartitioning"),
        "broadcast": text.count("BroadcastExchange"),
        "scans": text.count("FileScan"),
        "windows": len(re.findall(r"\bWindow \[", text)),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = get_spark("local[4]", app="tillroll-plans", shuffle_partitions=8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    print("| query | hash shuffles | shuffle keys | reused | single-partition | range | broadcast | scans | windows |")
    print("|---|---|---|---|---|---|---|---|---|")
    for name, q in sorted(QUERIES.items()):
        s = shape(q(spark, sf_dir)._jdf.queryExecution().executedPlan().toString())
        keys = ", ".join(f"{k}×{n}" if n > 1 else k for k, n in sorted(s["keys"].items()))
        print(f"| {name} | {s['hash']} | {keys} | {s['reused']} | {s['single']} | {s['range']} | "
              f"{s['broadcast']} | {s['scans']} | {s['windows']} |")


if __name__ == "__main__":
    main()
