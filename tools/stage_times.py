"""Summarise a Spark event log folder: wall time, jobs and stages per job group, slowest stages.

usage: python tools/stage_times.py <event log dir or file> [top_n]

Jobs that Spark starts from its own threads (scalar subqueries, broadcasts) do not carry the
caller's job group and are listed under "-", so per-group wall times are a lower bound.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
from collections import defaultdict


def _lines(path: str):
    files = sorted(glob.glob(os.path.join(path, "**", "events*"), recursive=True)) if os.path.isdir(path) else [path]
    for f in files:
        raw = open(f, "rb")
        if f.endswith(".zstd"):
            import zstandard
            raw = zstandard.ZstdDecompressor().stream_reader(raw)
        yield from io.TextIOWrapper(raw, encoding="utf-8")


def main() -> None:
    path, top = sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 10
    jobs, job_group, stages = {}, {}, {}
    for line in _lines(path):
        ev = json.loads(line)
        kind = ev["Event"]
        if kind == "SparkListenerJobStart":
            group = (ev.get("Properties") or {}).get("spark.jobGroup.id", "-")
            jobs[ev["Job ID"]] = [group, ev["Submission Time"], None, len(ev["Stage Infos"])]
            for st in ev["Stage Infos"]:
                job_group[st["Stage ID"]] = group
        elif kind == "SparkListenerJobEnd":
            jobs[ev["Job ID"]][2] = ev["Completion Time"]
        elif kind == "SparkListenerStageCompleted":
            info = ev["Stage Info"]
            if "Submission Time" in info and "Completion Time" in info:
                stages[info["Stage ID"]] = (info["Completion Time"] - info["Submission Time"], info["Number of Tasks"],
                                            info["Stage Name"], job_group.get(info["Stage ID"], "-"))
    per_group = defaultdict(lambda: [None, None, 0, 0])
    for group, start, end, n_stages in jobs.values():
        g = per_group[group]
        g[0] = start if g[0] is None else min(g[0], start)
        g[1] = (end or start) if g[1] is None else max(g[1], end or start)
        g[2] += 1
        g[3] += n_stages
    print(f"{'job group':32s} {'wall ms':>8s} {'jobs':>5s} {'stages':>6s}")
    for group, (start, end, n_jobs, n_stages) in sorted(per_group.items(), key=lambda kv: -(kv[1][1] - kv[1][0])):
        print(f"{group:32s} {end - start:8d} {n_jobs:5d} {n_stages:6d}")
    print(f"\nslowest stages")
    for sid, (ms, tasks, name, group) in sorted(stages.items(), key=lambda kv: -kv[1][0])[:top]:
        print(f"{ms:8d} ms  {tasks:4d} tasks  stage {sid:5d}  {group:28s} {name[:50]}")


if __name__ == "__main__":
    main()
