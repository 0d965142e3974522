"""Longest stages of a Spark event log (written with
``spark.eventLog.enabled=true`` and ``spark.eventLog.dir=<scratch folder>``).

usage: python scripts/stage_times.py <event log folder> [top_n]
"""

from __future__ import annotations

import glob
import io
import json
import sys


def lines(path: str):
    if path.endswith(".zstd"):
        import zstandard

        raw = zstandard.ZstdDecompressor().stream_reader(open(path, "rb"))
        yield from io.TextIOWrapper(raw, encoding="utf-8")
    else:
        yield from open(path, encoding="utf-8")


def main() -> None:
    folder = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages = []
    for path in glob.glob(f"{folder}/**/*", recursive=True):
        if "appstatus" in path or path.endswith(".crc") or not glob.os.path.isfile(path):
            continue
        for line in lines(path):
            event = json.loads(line)
            if event["Event"] != "SparkListenerStageCompleted":
                continue
            info = event["Stage Info"]
            scopes = []
            for rdd in info.get("RDD Info", []):
                if rdd.get("Scope"):
                    scope = json.loads(rdd["Scope"]).get("name", "")
                    if scope and scope not in scopes:
                        scopes.append(scope)
            seconds = (info.get("Completion Time", 0) - info.get("Submission Time", 0)) / 1000
            stages.append((seconds, info["Stage ID"], info["Number of Tasks"], " | ".join(scopes)))
    for seconds, stage, tasks, scopes in sorted(stages, reverse=True)[:top]:
        print(f"{seconds:7.2f}s stage {stage:4d} tasks {tasks:4d}  {scopes[:140]}")
    print(f"{len(stages)} stages, {sum(s[0] for s in stages):.1f}s summed")


if __name__ == "__main__":
    main()
