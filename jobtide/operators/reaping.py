"""Reaping of finished jobs: decision, pods, log archive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from jobtide.functions.status import is_terminal
from jobtide.operators.skew import skew_join

_JOB = ("job_namespace", "job_name")


def plan_reaping(status_messages: DataFrame, keep: Column) -> DataFrame:
    """What to do about each status message: archive logs, delete the job, or nothing."""
    done = is_terminal(F.col("routing_key"))
    return status_messages.withColumn(
        "action",
        F.when(done & ~keep, "archive+delete").when(done, "archive").otherwise("none"),
    )


def finished_jobs(plan: DataFrame) -> DataFrame:
    """Jobs whose logs are to be archived, each once."""
    return plan.where(F.col("action") != "none").select(*_JOB).distinct()


def pods_of_jobs(plan: DataFrame, pods: DataFrame, hot: Sequence[int] | None = None) -> DataFrame:
    """Pods of the finished jobs (pods carry ``job_namespace`` and ``job_name``)."""
    return skew_join(pods, finished_jobs(plan), _JOB, hot=hot)


def archive_summary(plan: DataFrame, pods: DataFrame) -> DataFrame:
    """Pods and log size per finished job, also for jobs without pods.

    Pods are counted per job before the join, so a job with very many pods is one row there.
    """
    per_job = pods.groupBy(*_JOB).agg(
        F.count(F.lit(1)).alias("pods"), F.sum("log_size").alias("log_size")
    )
    return finished_jobs(plan).join(per_job, list(_JOB), "left").na.fill(0, ["pods", "log_size"])


def pod_log_sizes(lines: DataFrame) -> DataFrame:
    """Characters per pod log, counting the line ends."""
    return lines.groupBy("job_namespace", "pod_name").agg(
        F.sum(F.length("line") + F.lit(1)).cast("bigint").alias("log_size"),
        F.count(F.lit(1)).alias("lines"),
    )


def archive_lines(plan: DataFrame, pods: DataFrame, lines: DataFrame, hot: Sequence[int] | None = None) -> DataFrame:
    """Log lines of all pods of finished jobs; a pod with very many lines is split."""
    chosen = pods_of_jobs(plan, pods).select("job_namespace", "pod_name", "job_name")
    return skew_join(lines, chosen, ["job_namespace", "pod_name"], hot=hot)
