"""Headline queries, timed: one warm-up and the median of three runs each."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from jobtide.plans.catalogue import ALL  # noqa: E402
from jobtide.session import local_session  # noqa: E402

HEADLINE = (
    "status_by_routing_key",
    "status_messages",
    "latest_job_state",
    "newest_condition_reason",
    "job_state_lookup",
    "retry_schedule",
    "message_disposition",
    "topic_match",
    "metadata_pairs",
    "launch_plan",
    "unique_filenames",
    "job_names",
    "reap_pod_logs",
    "job_pods",
    "log_lines_from",
    "log_tail_chunk",
    "job_log_links",
    "log_file_lines",
)


def run(spark, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    ALL[name][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores, app="bench")
    seconds = {}
    for name in names:
        run(spark, name, sf_dir)
        seconds[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(3)), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "cores": cores,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
