"""Summarize a Spark event log (written with spark.eventLog.dir to a scratch
folder): per stage the task count, wall time, slowest task and total task time.

    python tools/stage_times.py <eventlog dir or file>
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path: str):
    files = sorted(glob.glob(os.path.join(path, "events_*"))) if os.path.isdir(path) else [path]
    for f in files:
        raw = open(f, "rb")
        if f.endswith(".zstd"):
            import zstandard
            raw = zstandard.ZstdDecompressor().stream_reader(raw)
        yield from io.TextIOWrapper(raw, encoding="utf-8")


def summarize(path: str) -> list[dict]:
    stages: dict[int, dict] = {}
    t0 = None
    for line in _lines(path):
        e = json.loads(line)
        if e["Event"] == "SparkListenerJobStart" and t0 is None:
            t0 = e["Submission Time"]
        if e["Event"] == "SparkListenerTaskEnd":
            ti = e["Task Info"]
            st = stages.setdefault(e["Stage ID"], {"tasks": 0, "max_ms": 0, "sum_ms": 0,
                                                   "first": 1 << 62, "last": 0})
            dur = ti["Finish Time"] - ti["Launch Time"]
            st["tasks"] += 1
            st["max_ms"] = max(st["max_ms"], dur)
            st["sum_ms"] += dur
            st["first"] = min(st["first"], ti["Launch Time"])
            st["last"] = max(st["last"], ti["Finish Time"])
        if e["Event"] == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            stages.setdefault(si["Stage ID"], {})["name"] = si["Stage Name"][:48]
    out = []
    for sid, st in sorted(stages.items()):
        if "tasks" not in st:
            continue
        out.append({"stage": sid, "name": st.get("name"), "tasks": st["tasks"],
                    "start_ms": st["first"] - (t0 or 0), "wall_ms": st["last"] - st["first"],
                    "max_task_ms": st["max_ms"], "sum_task_ms": st["sum_ms"]})
    return out


if __name__ == "__main__":
    for row in summarize(sys.argv[1]):
        print(json.dumps(row))
