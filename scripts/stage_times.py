"""Per-stage times from a Spark event log (written to a scratch folder).

Run a query with ``spark.eventLog.enabled=true`` and ``spark.eventLog.dir=<scratch>``
(optionally tag it with ``sparkContext.setJobGroup(name, name)``), then:

    python scripts/stage_times.py <eventlog dir> [job group]

Prints, per stage: wall ms, tasks, executor run ms, CPU ms, shuffle bytes/records
written, input records, output bytes and GC ms.  Reads plain or zstd logs.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path: str):
    if path.endswith(".zstd"):
        import zstandard
        with open(path, "rb") as f:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(f), encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as f:
            yield from f


def stage_times(log_dir: str, group: str | None = None) -> list[tuple]:
    files = sorted(p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)
                   if os.path.isfile(p) and ("events" in os.path.basename(p)
                                             or os.path.basename(p).startswith("local-")))
    groups, out = {}, []
    for path in files:
        for line in _lines(path):
            e = json.loads(line)
            ev = e.get("Event")
            if ev == "SparkListenerJobStart":
                g = e.get("Properties", {}).get("spark.jobGroup.id")
                for s in e["Stage IDs"]:
                    groups[s] = g
            elif ev == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                if "Completion Time" not in si or (group and groups.get(si["Stage ID"]) != group):
                    continue
                acc = {a["Name"]: a.get("Value") for a in si.get("Accumulables", [])}
                out.append((si["Stage ID"], si["Completion Time"] - si["Submission Time"], si["Number of Tasks"],
                            acc.get("internal.metrics.executorRunTime"),
                            (acc.get("internal.metrics.executorCpuTime") or 0) // 1_000_000,
                            acc.get("internal.metrics.shuffle.write.bytesWritten"),
                            acc.get("internal.metrics.shuffle.write.recordsWritten"),
                            acc.get("internal.metrics.input.recordsRead"),
                            acc.get("internal.metrics.output.bytesWritten"),
                            acc.get("internal.metrics.jvmGCTime")))
    return sorted(out)


if __name__ == "__main__":
    rows = stage_times(sys.argv[1], sys.argv[2] if len(sys.argv) > 2 else None)
    print("stage wall_ms tasks run_ms cpu_ms shuffle_w_bytes shuffle_w_recs in_recs out_bytes gc_ms")
    for r in rows:
        print(*r)
