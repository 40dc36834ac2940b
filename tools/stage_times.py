"""Slowest stages of a run, from Spark's event log (no UI needed).

usage: python tools/stage_times.py <event-log-file-or-dir> [top]
"""

from __future__ import annotations

import json
import os
import sys


def load(path: str):
    files = sorted(os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs
                   if f.startswith("events") or f.startswith("local-")) if os.path.isdir(path) else [path]
    for f in files:
        if f.endswith(".zstd"):
            import io

            import zstandard

            with open(f, "rb") as raw:
                text = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
                for line in text:
                    if line.strip():
                        yield json.loads(line)
        else:
            with open(f, encoding="utf-8") as fh:
                for line in fh:
                    if line.strip():
                        yield json.loads(line)


def main(argv):
    top = int(argv[2]) if len(argv) > 2 else 15
    stages, tasks = {}, {}
    for ev in load(argv[1]):
        kind = ev.get("Event")
        if kind == "SparkListenerStageCompleted":
            info = ev["Stage Info"]
            dur = (info.get("Completion Time", 0) - info.get("Submission Time", 0)) / 1000
            stages[info["Stage ID"]] = (dur, info["Stage Name"][:70], info["Number of Tasks"])
        elif kind == "SparkListenerTaskEnd":
            m = ev.get("Task Metrics") or {}
            sid = ev["Stage ID"]
            agg = tasks.setdefault(sid, [0, 0, 0, 0])
            agg[0] += m.get("Executor Run Time", 0) / 1000
            agg[1] += (m.get("Shuffle Read Metrics") or {}).get("Remote Bytes Read", 0) + \
                (m.get("Shuffle Read Metrics") or {}).get("Local Bytes Read", 0)
            agg[2] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
            agg[3] = max(agg[3], m.get("Executor Run Time", 0) / 1000)
    total = sum(d for d, _, _ in stages.values())
    print(f"{len(stages)} stages, {total:.1f}s stage wall time (summed)")
    print(f"{'stage':>5} {'wall s':>7} {'tasks':>5} {'cpu s':>7} {'max task':>8} {'shuf rd MB':>10} {'shuf wr MB':>10}  name")
    for sid, (dur, name, n) in sorted(stages.items(), key=lambda kv: -kv[1][0])[:top]:
        t = tasks.get(sid, [0, 0, 0, 0])
        print(f"{sid:>5} {dur:7.2f} {n:>5} {t[0]:7.2f} {t[3]:8.2f} {t[1] / 1e6:10.2f} {t[2] / 1e6:10.2f}  {name}")


if __name__ == "__main__":
    main(sys.argv)
