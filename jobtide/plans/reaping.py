"""Queries over finished jobs, their pods and logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobtide.functions.text import parse_flag
from jobtide.operators import reaping
from jobtide.plans.adapters import view, with_views
from jobtide.session import run_dir
from jobtide.sinks.files import publish, write_pod_logs
from jobtide.sources.logfiles import read_pod_logs

_KEEP = "coalesce(lower(keep_text) IN ('true', 'yes'), false)"
_ACTION = f"""CASE WHEN routing_key NOT IN ('cds.job.failed', 'cds.job.success') THEN 'none'
    WHEN {_KEEP} THEN 'archive' ELSE 'archive+delete' END"""
PLAN = f"SELECT *, {_ACTION} AS action FROM job_messages"


def _plan(spark, sf):
    return reaping.plan_reaping(view(spark, sf, "job_messages"), parse_flag(F.col("keep_text")))


def reap_plan(spark, sf):
    return _plan(spark, sf).select("order_key", "job_name", "routing_key", "action")


PLAN_SQL = with_views("job_messages", plan=PLAN) + "SELECT order_key, job_name, routing_key, action FROM plan"


def reap_pod_logs(spark, sf):
    return reaping.archive_summary(_plan(spark, sf), view(spark, sf, "pods"))


POD_LOGS_SQL = with_views("job_messages", "pods", plan=PLAN) + """
SELECT p.job_namespace, p.job_name, count(q.job_name) AS pods, CAST(coalesce(sum(q.log_size), 0) AS BIGINT) AS log_size
FROM plan p LEFT JOIN pods q USING (job_namespace, job_name) WHERE action <> 'none' GROUP BY 1, 2"""


def job_pods(spark, sf):
    """Pods of the finished jobs, one row per pod."""
    return reaping.pods_of_jobs(_plan(spark, sf), view(spark, sf, "pods"))


PODS_SQL = with_views("job_messages", "pods", plan=PLAN) + """
SELECT q.* FROM pods q JOIN plan p USING (job_namespace, job_name) WHERE action <> 'none'"""

_POD_KEY = "'cds.job.' || CASE job_number % 3 WHEN 0 THEN 'failed' WHEN 1 THEN 'success' ELSE 'running' END"


def archived_pod_logs(spark, sf):
    """Logs of the pods of finished jobs, written to files and read back."""
    lines = view(spark, sf, "pod_lines")
    jobs = lines.select("job_namespace", "job_name", F.expr(_POD_KEY).alias("routing_key")).distinct()
    plan = reaping.plan_reaping(jobs, F.lit(False))
    pods = lines.select("job_namespace", "job_name", "pod_name").distinct()
    chosen = reaping.archive_lines(
        plan, pods, lines.select("job_namespace", "pod_name", "line_no", "line")
    )
    folder = run_dir(spark, "pod-logs")
    # a log archived again takes the place of the first one
    for _ in range(2):
        write_pod_logs(chosen, folder)
    back = read_pod_logs(spark, folder)
    return reaping.pod_log_sizes(back.withColumn("job_namespace", F.lit("ns0"))).withColumnRenamed(
        "lines", "line_count"
    )


ARCHIVE_SQL = with_views("pod_lines") + """
SELECT job_namespace, pod_name, CAST(sum(length(line) + 1) AS BIGINT) AS log_size, count(*) AS line_count
FROM pod_lines WHERE job_number % 3 < 2 GROUP BY 1, 2"""


def published_by_key(spark, sf):
    """Reaping decisions published as JSON lines per routing key and read back."""
    body = F.to_json(F.struct("job_name", "action"))
    folder = run_dir(spark, "published")
    publish(_plan(spark, sf).withColumn("body", body), folder, "one", max_bytes=1 << 20)
    back = spark.read.text(folder)
    action = F.get_json_object("value", "$.action")
    return back.groupBy("routing_key", action.alias("action")).agg(F.count(F.lit(1)).alias("messages"))


PUBLISHED_SQL = with_views("job_messages", plan=PLAN) + """
SELECT routing_key, action, count(*) AS messages FROM plan GROUP BY 1, 2"""

QUERIES = {
    "reap_plan": (reap_plan, PLAN_SQL),
    "reap_pod_logs": (reap_pod_logs, POD_LOGS_SQL),
    "job_pods": (job_pods, PODS_SQL),
    "archived_pod_logs": (archived_pod_logs, ARCHIVE_SQL),
    "published_by_key": (published_by_key, PUBLISHED_SQL),
}
