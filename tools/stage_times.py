"""Job, stage and task times from a Spark event log (no UI, no REST interface).

Usage: python tools/stage_times.py <event-log-dir> [--since SECONDS]

Write the log with BENCH_EVENT_LOG_DIR=$(mktemp -d /tmp/run-XXXXXX) python bench.py, or
``local_session(event_log_dir=...)``. Handles plain and zstd-compressed rolling logs.
"""

from __future__ import annotations

import argparse
import glob
import io
import json
import os
from collections import Counter, defaultdict


def _lines(path: str):
    if path.endswith(".zstd"):
        import zstandard

        raw = zstandard.ZstdDecompressor().stream_reader(open(path, "rb"))
        yield from io.TextIOWrapper(raw, encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as f:
            yield from f


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("log_dir")
    ap.add_argument("--since", type=float, default=0.0, help="skip jobs that start earlier (seconds)")
    a = ap.parse_args()
    files = [f for f in glob.glob(os.path.join(a.log_dir, "**", "*"), recursive=True) if "events_" in f or f.endswith(".json")]
    if not files:
        raise SystemExit(f"no event log under {a.log_dir}")
    path = max(files, key=os.path.getmtime)
    jobs, stages, tasks = {}, {}, defaultdict(Counter)
    for line in _lines(path):
        e = json.loads(line)
        ev = e["Event"]
        if ev == "SparkListenerJobStart":
            jobs[e["Job ID"]] = [e["Submission Time"], None, e["Stage IDs"]]
        elif ev == "SparkListenerJobEnd":
            jobs[e["Job ID"]][1] = e["Completion Time"]
        elif ev == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            stages[si["Stage ID"]] = (si.get("Submission Time", 0), si.get("Completion Time", 0), si["Number of Tasks"])
        elif ev == "SparkListenerTaskEnd" and e.get("Task Metrics"):
            m, t = e["Task Metrics"], tasks[e["Stage ID"]]
            t["run_ms"] += m["Executor Run Time"]
            t["cpu_ms"] += m["Executor CPU Time"] / 1e6
            t["gc_ms"] += m["JVM GC Time"]
            t["shuffle_write_rows"] += m["Shuffle Write Metrics"]["Shuffle Records Written"]
            t["shuffle_write_mb"] += m["Shuffle Write Metrics"]["Shuffle Bytes Written"] / 1e6
            t["shuffle_read_rows"] += m["Shuffle Read Metrics"]["Total Records Read"]
            t["input_rows"] += m["Input Metrics"]["Records Read"]
            t["spill_mb"] += m["Disk Bytes Spilled"] / 1e6
    t0 = min(j[0] for j in jobs.values())
    for jid in sorted(jobs):
        start, end, sids = jobs[jid]
        if (start - t0) / 1000 < a.since or end is None:
            continue
        print(f"job {jid}: start {(start - t0) / 1000:.2f}s, {(end - start) / 1000:.2f}s")
        for sid in sids:
            if sid in stages:
                s0, s1, n = stages[sid]
                m = {k: round(v, 1) for k, v in tasks[sid].items()}
                print(f"  stage {sid}: {(s1 - s0) / 1000:.2f}s, {n} tasks, {m}")


if __name__ == "__main__":
    main()
