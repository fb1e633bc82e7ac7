"""Summarize a Spark event log: job durations and per-stage task run, CPU and GC time.

Write an event log with ``spark.eventLog.enabled=true`` and ``spark.eventLog.dir``
pointing at a scratch folder, then: python tools/stage_times.py <event log file>
(plain JSON lines or the zstd-compressed rolling file).
"""

from __future__ import annotations

import io
import json
import sys


def _lines(path: str):
    if path.endswith(".zstd") or path.endswith(".zst"):
        import zstandard

        raw = zstandard.ZstdDecompressor().stream_reader(open(path, "rb"))
        yield from io.TextIOWrapper(raw, encoding="utf-8")
    else:
        yield from open(path, encoding="utf-8")


def main() -> None:
    stages: dict[int, dict] = {}
    jobs: dict[int, dict] = {}
    for line in _lines(sys.argv[1]):
        e = json.loads(line)
        kind = e["Event"]
        if kind == "SparkListenerJobStart":
            jobs[e["Job ID"]] = {"start": e["Submission Time"], "stages": e["Stage IDs"]}
        elif kind == "SparkListenerJobEnd":
            jobs[e["Job ID"]]["end"] = e["Completion Time"]
        elif kind == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            s = stages.setdefault(info["Stage ID"], {})
            s["name"] = info["Stage Name"][:60]
            s["wall"] = info["Completion Time"] - info["Submission Time"]
        elif kind == "SparkListenerTaskEnd" and e.get("Task Metrics"):
            m = e["Task Metrics"]
            s = stages.setdefault(e["Stage ID"], {})
            s["tasks"] = s.get("tasks", 0) + 1
            s["run"] = s.get("run", 0) + m["Executor Run Time"]
            s["cpu"] = s.get("cpu", 0) + m.get("Executor CPU Time", 0) / 1e6
            s["gc"] = s.get("gc", 0) + m["JVM GC Time"]
    for jid, j in sorted(jobs.items()):
        print(f"job {jid}: {j.get('end', j['start']) - j['start']} ms")
        for sid in j["stages"]:
            s = stages.get(sid)
            if s and "wall" in s:
                print(f"  stage {sid}: wall {s['wall']} ms, tasks {s.get('tasks', 0)}, run {s.get('run', 0)} ms, "
                      f"cpu {s.get('cpu', 0):.0f} ms, gc {s.get('gc', 0)} ms")


if __name__ == "__main__":
    main()
