"""Job change events: filters, classification, status messages, latest state, positions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from jobtide import fixed
from jobtide.functions import status as st
from jobtide.functions.text import parse_position
from jobtide.operators.skew import skew_join

_COUNTERS = ("active", "failed", "succeeded", "start_time")


def _conditions(prefix: str) -> dict[str, Column]:
    """What an event must fulfil to be processed, by the reason given when it does not."""
    return {
        "not_a_job": F.col("object_kind") == "Job",
        "other_name": F.col("name").startswith(prefix),
        "deleted": F.col("watch_type") != "DELETED",
    }


def skip_reason(prefix: str = fixed.JOB_PREFIX) -> Column:
    """Why an event is not processed, NULL when it is.

    An event without kind, name or type (among them lines that are no JSON) is malformed.
    """
    conditions = _conditions(prefix)
    unknown = reduce(lambda a, b: a | b, (c.isNull() for c in conditions.values()))
    reason = F.when(unknown, "malformed")
    for name, fulfilled in conditions.items():
        reason = reason.when(~fulfilled, name)
    return reason


def watched_events(
    events: DataFrame, prefix: str = fixed.JOB_PREFIX, namespace: str | None = None
) -> DataFrame:
    """Events without a reason to skip them, of one namespace if given.

    The conditions stand side by side, so the scan takes what it can of them.
    """
    kept = events.where(reduce(lambda a, b: a & b, _conditions(prefix).values()))
    return kept if namespace is None else kept.where(F.col("namespace") == namespace)


def classify_jobs(
    events: DataFrame, prefix: str = fixed.JOB_PREFIX, namespace: str | None = None
) -> DataFrame:
    """Watched events with status, routing key, retry count, failure reason."""
    active, failed, succeeded, start = (F.col(c) for c in _COUNTERS)
    kept = watched_events(events, prefix, namespace)
    classified = kept.withColumns(
        {
            "status": st.job_status(active, failed, succeeded, start),
            "suspect_failed": st.is_suspect_failure(active, failed, succeeded, start),
            "retry_count": F.coalesce(failed, F.lit(0)),
        }
    ).withColumn("routing_key", st.routing_key(F.col("status")))
    if "conditions" not in events.columns:
        return classified
    return classified.withColumn(
        "failure_reason",
        F.when(F.col("status") == fixed.FAILED, st.failure_reason(F.col("conditions"))),
    )


def message_body(failure_reason: Column | None = None) -> Column:
    """Status message as JSON; a NULL failure reason leaves its field out."""
    fields = [
        F.col("job_id").alias("job-id"),
        F.col("job_name").alias("job-name"),
        F.col("job_namespace").alias("job-namespace"),
        F.col("retry_count").alias("retry-count"),
    ]
    if failure_reason is not None:
        fields.append(failure_reason.alias("failure-reason"))
    return F.to_json(F.struct(*fields))


def status_messages(classified: DataFrame) -> DataFrame:
    """One outgoing message per classified event."""
    reason = (
        F.col("failure_reason")
        if "failure_reason" in classified.columns
        else F.lit(None).cast("string")
    )
    shaped = classified.select(
        "resource_version",
        "routing_key",
        F.col("uid").alias("job_id"),
        F.col("name").alias("job_name"),
        F.col("namespace").alias("job_namespace"),
        "retry_count",
        reason.alias("failure_reason"),
    )
    return shaped.withColumn("body", message_body(F.col("failure_reason")))


def newest_condition(
    conditions: DataFrame,
    keys: Sequence[str],
    probe_time: str,
    position: Sequence[str],
    take: Sequence[str],
) -> DataFrame:
    """Newest condition per key from a table with one condition per row.

    A minimum over (age, list position) is found with partial aggregation, hence a job with
    very many conditions is reduced before the shuffle.  Missing times count as oldest.
    """
    age = F.coalesce(-F.unix_micros(F.col(probe_time).cast("timestamp")), F.lit((1 << 63) - 1))
    entry = F.struct(age.alias("age"), *position, *[c for c in take if c not in position])
    return (
        conditions.groupBy(*keys)
        .agg(F.min(entry).alias("newest"))
        .select(*keys, *[F.col("newest")[c].alias(c) for c in take])
    )


def deduplicate(events: DataFrame) -> DataFrame:
    """One row per change, however often it was delivered."""
    return events.dropDuplicates(["uid", "resource_version"])


def latest_state(
    events: DataFrame, key: str = "uid", version: str = "resource_version"
) -> DataFrame:
    """The newest row of each job; partially aggregated before the shuffle."""
    rest = [c for c in events.columns if c not in (key, version)]
    return (
        events.groupBy(key)
        .agg(F.max(F.struct(version, *rest)).alias("newest"))
        .select(key, *[F.col("newest")[c].alias(c) for c in (version, *rest)])
    )


def parse_state(stored: DataFrame, key: str = "uid", body: str = "state_json") -> DataFrame:
    """Stored JSON states; ``purge`` marks those that are broken or lack a field."""
    shape = "uid string, name string, status string, timestamp double"
    parsed = stored.withColumn("__state", F.from_json(body, shape))
    fields = [F.col("__state")[f] for f in ("uid", "name", "status", "timestamp")]
    broken = F.col("__state").isNull()
    for field in fields:
        broken = broken | field.isNull()
    return parsed.select(
        F.col(key),
        F.when(~broken, fields[1]).alias("name"),
        F.when(~broken, fields[2]).alias("status"),
        F.when(~broken, fields[3]).alias("timestamp"),
        broken.alias("purge"),
    )


def with_last_state(
    events: DataFrame, states: DataFrame, key: str = "uid", hot: Sequence[int] | None = None
) -> DataFrame:
    """Each event next to the last recorded state of its job, if there is a valid one."""
    known = states.where(~F.col("purge")).select(
        key, F.col("status").alias("last_status"), F.col("timestamp").alias("last_seen")
    )
    return skew_join(events, known, [key], "left", hot)


# --- positions in the change stream ------------------------------------------------


def after_cursor(events: DataFrame, cursor: int | None) -> DataFrame:
    """Events after the position; without one only events still to come, that is none.

    The position is a plain literal, so it reaches the scan as a pushed filter.
    """
    if cursor is None:
        return events.where(F.lit(False))
    return events.where(F.col("resource_version") > F.lit(int(cursor)))


def advance(processed: DataFrame) -> DataFrame:
    """High-water mark of the processed rows (one row, NULL when there are none)."""
    return processed.agg(F.max("resource_version").alias("cursor"))


def snapshot_position(events: DataFrame) -> DataFrame:
    """Where a first run starts: the newest serial there is."""
    return events.agg(F.max("resource_version").alias("cursor"))


def read_positions(journal: DataFrame, text: str = "position_text") -> DataFrame:
    """Journal texts as numbers; what is not a number is marked for removal."""
    value = parse_position(F.col(text))
    return journal.withColumns(
        {"position": value, "purge": F.col(text).isNotNull() & value.isNull()}
    )


def find_gap(events: DataFrame, cursors: DataFrame) -> DataFrame:
    """Per namespace: is the position older than what is still kept, and where to go on.

    Events up to the oldest kept serial are gone; a position before that restarts at the
    newest serial and the gap is reported.
    """
    kept = events.groupBy("namespace").agg(
        F.min("resource_version").alias("oldest"), F.max("resource_version").alias("newest")
    )
    gap = F.col("cursor") < F.col("oldest") - 1
    lost = cursors.join(kept, "namespace", "left").withColumn("gap", F.coalesce(gap, F.lit(False)))
    restart = F.col("gap") | F.col("cursor").isNull()
    return lost.withColumn("resume_at", F.when(restart, F.col("newest")).otherwise(F.col("cursor")))
