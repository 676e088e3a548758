"""Summarize job and stage durations from a Spark event log (plain or zstd-compressed).

Usage: python tools/stage_times.py <event-log file or directory>

Write the log with spark.eventLog.enabled=true and spark.eventLog.dir=<scratch folder>, e.g.
BENCH_EVENT_LOG_DIR=$(mktemp -d /tmp/run-XXXXXX) python bench.py
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path: str):
    raw = open(path, "rb")
    if path.endswith(".zstd"):
        import zstandard

        raw = zstandard.ZstdDecompressor().stream_reader(raw)
    yield from io.TextIOWrapper(raw, encoding="utf-8")


def main() -> None:
    target = sys.argv[1]
    files = [target] if os.path.isfile(target) else sorted(
        f for f in glob.glob(os.path.join(target, "**", "*"), recursive=True)
        if os.path.isfile(f) and "appstatus" not in f)
    jobs: dict[int, list] = {}
    stages: dict[int, tuple] = {}
    for path in files:
        for line in _lines(path):
            event = json.loads(line)
            kind = event.get("Event")
            if kind == "SparkListenerJobStart":
                desc = event.get("Properties", {}).get("spark.job.description") or ""
                jobs[event["Job ID"]] = [desc, event["Submission Time"], [s["Stage ID"] for s in event["Stage Infos"]]]
            elif kind == "SparkListenerJobEnd" and event["Job ID"] in jobs:
                jobs[event["Job ID"]][1] = event["Completion Time"] - jobs[event["Job ID"]][1]
            elif kind == "SparkListenerStageCompleted":
                info = event["Stage Info"]
                stages[info["Stage ID"]] = (info["Stage Name"][:48], info["Number of Tasks"],
                                            info.get("Completion Time", 0) - info.get("Submission Time", 0))
    for job_id, (desc, ms, stage_ids) in sorted(jobs.items()):
        ran = [f"s{sid}:{stages[sid][1]}t/{stages[sid][2]}ms" for sid in stage_ids if sid in stages]
        print(f"job {job_id:4d} {ms:7d} ms  {desc[:40]:40s} {' '.join(ran)}")


if __name__ == "__main__":
    main()
