"""Summarize stage times from a Spark event log (no UI needed).

    BENCH_EVENTLOG_DIR=$(mktemp -d /tmp/run-XXXXXX) python bench.py
    python tools/stage_times.py $BENCH_EVENTLOG_DIR/<app-id> [top]

Prints the slowest stages: wall time, task count, summed task run time,
shuffle read/write bytes and the stage name (the call site).
"""

from __future__ import annotations

import json
import os
import sys


def _lines(path: str):
    # Spark 4 writes a rolling log: a folder of numbered event files.
    files = sorted(os.path.join(path, f) for f in os.listdir(path) if f.startswith("events")) \
        if os.path.isdir(path) else [path]
    for f in files:
        if f.endswith(".zstd"):  # Spark's default event-log codec
            import io

            import zstandard

            with open(f, "rb") as raw:
                reader = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True)
                yield from io.TextIOWrapper(reader, encoding="utf-8")
        else:
            with open(f, encoding="utf-8") as fh:
                yield from fh


def stages(path: str):
    out = []
    for line in _lines(path):
        ev = json.loads(line)
        if ev.get("Event") != "SparkListenerStageCompleted":
            continue
        info = ev["Stage Info"]
        acc = {a.get("Name"): a.get("Value") for a in info.get("Accumulables", [])}
        wall = (info.get("Completion Time", 0) - info.get("Submission Time", 0)) / 1000
        out.append({
            "stage": info["Stage ID"],
            "wall_s": round(wall, 3),
            "tasks": info.get("Number of Tasks"),
            "run_s": round((acc.get("internal.metrics.executorRunTime") or 0) / 1000, 3),
            "shuffle_read": (acc.get("internal.metrics.shuffle.read.remoteBytesRead") or 0)
            + (acc.get("internal.metrics.shuffle.read.localBytesRead") or 0),
            "shuffle_write": acc.get("internal.metrics.shuffle.write.bytesWritten") or 0,
            "name": info.get("Stage Name", "")[:80],
        })
    return out


def main() -> None:
    rows = sorted(stages(sys.argv[1]), key=lambda r: -r["wall_s"])
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    for r in rows[:top]:
        print(f"{r['stage']:5d} {r['wall_s']:8.3f}s {r['tasks']:5d} tasks run {r['run_s']:8.3f}s "
              f"shuffle r/w {r['shuffle_read']:>12} / {r['shuffle_write']:>12}  {r['name']}")


if __name__ == "__main__":
    main()
