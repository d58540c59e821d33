"""A table of all queries with check SQL or without: seconds, rows read, rows per second, shuffled MB (one run after one warm-up)."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from bench import run  # noqa: E402
from jobtide.plans.catalogue import ALL  # noqa: E402
from jobtide.session import local_session  # noqa: E402


def totals(log: Path, spans: dict[str, tuple[float, float]]) -> dict[str, tuple[int, int]]:
    """Rows read from files and bytes written to shuffles, by query."""
    found = {name: [0, 0] for name in spans}
    for line in log.open():
        event = json.loads(line)
        if event["Event"] != "SparkListenerTaskEnd":
            continue
        at, metrics = event["Task Info"]["Launch Time"] / 1000, event.get("Task Metrics") or {}
        for name, (begin, end) in spans.items():
            if begin <= at <= end:
                found[name][0] += metrics.get("Input Metrics", {}).get("Records Read", 0)
                found[name][1] += metrics.get("Shuffle Write Metrics", {}).get("Shuffle Bytes Written", 0)
    return {name: tuple(x) for name, x in found.items()}


def main() -> None:
    sf_dir, cores = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    folder = tempfile.mkdtemp(prefix="run-")
    settings = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{folder}", "spark.eventLog.rolling.enabled": "false", "spark.eventLog.compress": "false"}
    spark = local_session(cores, app="bench-table", **settings)
    spans = {}
    for name in sys.argv[1:] or ALL:
        run(spark, name, sf_dir)
        begin = time.time()
        run(spark, name, sf_dir)
        spans[name] = begin, time.time()
        print(name, round(spans[name][1] - begin, 2), file=sys.stderr, flush=True)
    spark.stop()
    measured = totals(next(Path(folder).iterdir()), spans)
    print("| query | seconds | rows read | rows / s | shuffled MB |\n| --- | --- | --- | --- | --- |")
    for name, (begin, end) in spans.items():
        rows, shuffled = measured[name]
        print(f"| {name} | {end - begin:.2f} | {rows:,} | {rows / (end - begin):,.0f} | {shuffled / 1e6:.2f} |")


if __name__ == "__main__":
    main()
