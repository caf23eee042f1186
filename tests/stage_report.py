"""Per-query jobs, stages and task time from a Spark event log written by bench.py.

    BENCH_EVENT_LOG=$(mktemp -d /tmp/run-XXXXXX) python bench.py
    python tests/stage_report.py <that folder>

bench.py tags every query's jobs with a job group named after the query, so
each stage can be attributed. Prints one line per query: jobs, stages, tasks,
summed task run time and the longest stage.
"""

from __future__ import annotations

import glob
import json
import os
import sys
from collections import defaultdict


def _lines(path: str):
    """Event-log lines from a plain or zstd-compressed file, or a rolling-log folder."""
    files = sorted(glob.glob(os.path.join(path, "events_*"))) if os.path.isdir(path) else [path]
    for name in files:
        if name.endswith(".zstd"):
            import io

            import zstandard
            with open(name, "rb") as raw:
                text = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
                yield from text
        else:
            with open(name) as f:
                yield from f


def main(folder: str) -> None:
    logs = sorted(glob.glob(os.path.join(folder, "*")), key=os.path.getmtime)
    if not logs:
        raise SystemExit(f"no event log in {folder}")
    stage_query, jobs = {}, defaultdict(int)
    stages = defaultdict(list)
    for line in _lines(logs[-1]):
        ev = json.loads(line)
        kind = ev.get("Event")
        if kind == "SparkListenerJobStart":
            group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
            if group:
                jobs[group] += 1
                for sid in ev.get("Stage IDs", []):
                    stage_query[sid] = group
        elif kind == "SparkListenerStageCompleted":
            info = ev["Stage Info"]
            q = stage_query.get(info["Stage ID"])
            if q is None or "Completion Time" not in info:
                continue
            run_ms = sum(a.get("Value", 0) for a in info.get("Accumulables", [])
                         if a.get("Name") == "internal.metrics.executorRunTime")
            stages[q].append((info["Completion Time"] - info["Submission Time"], info["Number of Tasks"],
                              run_ms, info["Stage Name"].split(" at ")[0]))
    print(f"{'query':28s} {'jobs':>4s} {'stages':>6s} {'tasks':>6s} {'task s':>7s}  longest stage")
    for q, st in stages.items():
        longest = max(st)
        print(f"{q:28s} {jobs[q]:4d} {len(st):6d} {sum(s[1] for s in st):6d} {sum(s[2] for s in st) / 1000:7.2f}"
              f"  {longest[0] / 1000:.2f}s {longest[3]}")


if __name__ == "__main__":
    main(sys.argv[1])
