"""Queries over job change events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from jobtide.functions import status as st
from jobtide.operators import jobs
from jobtide.operators.retry import retry_schedule as plan_retries
from jobtide.plans.adapters import view, with_views

# --- check queries: shared parts -----------------------------------------------------

WATCHED = "SELECT * FROM job_events WHERE object_kind = 'Job' AND name LIKE 'cds-%' AND watch_type <> 'DELETED'"
STATUS_CASE = """CASE
    WHEN active > 0 AND (failed IS NULL OR failed = 0) THEN 'running'
    WHEN active > 0 AND failed > 0 THEN 'retry'
    WHEN start_time IS NULL AND active IS NULL AND failed IS NULL AND succeeded IS NULL THEN 'starting'
    WHEN (active IS NULL OR active = 0) AND (succeeded IS NULL OR succeeded = 0) AND start_time IS NOT NULL THEN 'failed'
    WHEN (active IS NULL OR active = 0) AND succeeded > 0 THEN 'success' END"""
CLASSIFIED = (
    f"SELECT *, 'cds.job.' || coalesce(status, 'None') AS routing_key, coalesce(failed, 0) AS retry_count"
    f" FROM (SELECT *, {STATUS_CASE} AS status FROM watched)"
)


def classified_sql(**more: str) -> str:
    return with_views("job_events", watched=WATCHED, classified=CLASSIFIED, **more)


# --- queries ---------------------------------------------------------------------------

# Conditions of an event: none, an empty list or up to three, some without time or reason.
CONDITIONS = """CASE WHEN event_id % 8 = 0 THEN NULL ELSE
    transform(slice(array(0, 1, 2), 1, CAST(event_id % 4 AS INT)), i -> named_struct(
        'last_probe_time', CASE WHEN (event_id + i) % 11 = 0 THEN NULL
            ELSE CAST(ts AS TIMESTAMP) + make_dt_interval(0, 0, 0, (event_id * 7 + i * 5) % 3) END,
        'reason', CASE WHEN (event_id + i) % 7 = 0 THEN NULL ELSE 'reason-' || CAST(i AS STRING) END,
        'message', 'step ' || CAST((event_id + i) % 13 AS STRING))) END"""


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "job_events")


def events_with_conditions(spark: SparkSession, sf: str) -> DataFrame:
    return _events(spark, sf).withColumn("conditions", F.expr(CONDITIONS))


def _count(name: str = "events"):
    return F.count(F.lit(1)).alias(name)


def count_by_key(classified: DataFrame) -> DataFrame:
    return classified.groupBy("routing_key").agg(
        _count(),
        F.countDistinct("name").alias("jobs"),
        F.sum("retry_count").cast("bigint").alias("retries"),
    )


def status_by_routing_key(spark, sf):
    return count_by_key(jobs.classify_jobs(_events(spark, sf)))


STATUS_BY_KEY_SQL = classified_sql() + """
SELECT routing_key, count(*) AS events, count(DISTINCT name) AS jobs, CAST(sum(retry_count) AS BIGINT) AS retries
FROM classified GROUP BY routing_key"""


def status_messages(spark, sf):
    return jobs.status_messages(jobs.classify_jobs(events_with_conditions(spark, sf)))


STATUS_MESSAGES_SQL = classified_sql(
    listed="""SELECT event_id, i,
        CASE WHEN (event_id + i) % 11 = 0 THEN NULL ELSE ts + to_seconds((event_id * 7 + i * 5) % 3) END AS probed,
        CASE WHEN (event_id + i) % 7 = 0 THEN 'None' ELSE 'reason-' || CAST(i AS VARCHAR) END
            || ' - step ' || CAST((event_id + i) % 13 AS VARCHAR) AS reason
        FROM (SELECT event_id, ts, unnest(range(event_id % 4)) AS i FROM classified WHERE event_id % 8 <> 0)""",
    newest="""SELECT event_id, reason FROM listed
        QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY probed DESC NULLS LAST, i) = 1""",
    messages="""SELECT resource_version, routing_key, uid AS job_id, name AS job_name,
        namespace AS job_namespace, retry_count,
        CASE WHEN status = 'failed' THEN coalesce(reason, 'Unknown') END AS failure_reason
        FROM classified LEFT JOIN newest USING (event_id)""",
) + """
SELECT *, '{"job-id":"' || job_id || '","job-name":"' || job_name || '","job-namespace":"' || job_namespace
    || '","retry-count":' || CAST(retry_count AS VARCHAR)
    || coalesce(',"failure-reason":"' || failure_reason || '"', '') || '}' AS body
FROM messages"""


def unclassified_events(spark, sf):
    unknown = jobs.classify_jobs(_events(spark, sf)).where(F.col("status").isNull())
    return unknown.select("resource_version", "uid", "name", "routing_key")


UNCLASSIFIED_SQL = classified_sql() + """
SELECT resource_version, uid, name, routing_key FROM classified WHERE status IS NULL"""


def suspect_failures(spark, sf):
    found = jobs.classify_jobs(_events(spark, sf)).where("suspect_failed AND status = 'failed'")
    return found.select("resource_version", "uid", "name", "retry_count")


SUSPECT_SQL = classified_sql() + """
SELECT resource_version, uid, name, retry_count FROM classified
WHERE status = 'failed' AND active IS NULL AND failed IS NULL AND succeeded IS NULL"""


def status_rules(spark, sf):
    events = jobs.watched_events(_events(spark, sf))
    a, f, s, t = (F.col(c) for c in ("active", "failed", "succeeded", "start_time"))
    return (
        events.select(
            st.is_starting(a, f, s, t).alias("starting"),
            st.is_running(a, f).alias("running"),
            st.is_retry(a, f).alias("retry"),
            st.is_failed(a, s, t).alias("failed_rule"),
            st.is_success(a, s).alias("success"),
        )
        .groupBy("starting", "running", "retry", "failed_rule", "success")
        .agg(_count())
    )


STATUS_RULES_SQL = with_views("job_events", watched=WATCHED) + """
SELECT start_time IS NULL AND active IS NULL AND failed IS NULL AND succeeded IS NULL AS starting,
    coalesce(active > 0, false) AND (failed IS NULL OR failed = 0) AS running,
    coalesce(active > 0 AND failed > 0, false) AS retry,
    (active IS NULL OR active = 0) AND (succeeded IS NULL OR succeeded = 0) AND start_time IS NOT NULL AS failed_rule,
    (active IS NULL OR active = 0) AND coalesce(succeeded > 0, false) AS success,
    count(*) AS events
FROM watched GROUP BY ALL"""


def skipped_events(spark, sf):
    why = F.coalesce(jobs.skip_reason(), F.lit("processed"))
    return _events(spark, sf).groupBy(why.alias("skipped")).agg(_count())


SKIPPED_SQL = with_views("job_events") + """
SELECT CASE WHEN object_kind <> 'Job' THEN 'not_a_job' WHEN name NOT LIKE 'cds-%' THEN 'other_name'
    WHEN watch_type = 'DELETED' THEN 'deleted' ELSE 'processed' END AS skipped, count(*) AS events
FROM job_events GROUP BY 1"""


def namespace_events(spark, sf):
    return jobs.classify_jobs(_events(spark, sf), namespace="ns1").groupBy("routing_key").agg(_count())


NAMESPACE_SQL = classified_sql() + """
SELECT routing_key, count(*) AS events FROM classified WHERE namespace = 'ns1' GROUP BY 1"""


def _redelivered(spark, sf) -> DataFrame:
    """All events, some of them delivered twice."""
    deliveries = F.expr("sequence(1, CASE WHEN event_id % 7 = 0 THEN 2 ELSE 1 END)")
    return _events(spark, sf).withColumn("delivery", F.explode(deliveries)).drop("delivery")


def deduplicated_events(spark, sf):
    kept = jobs.deduplicate(jobs.watched_events(_redelivered(spark, sf)))
    return kept.groupBy("watch_type").agg(_count())


DEDUPLICATED_SQL = with_views("job_events", watched=WATCHED) + """
SELECT watch_type, count(*) AS events FROM watched GROUP BY 1"""


def latest_job_state(spark, sf):
    classified = jobs.classify_jobs(_redelivered(spark, sf))
    return jobs.latest_state(classified.select("uid", "resource_version", "name", "status"))


LATEST_SQL = classified_sql() + """
SELECT uid, max(resource_version) AS resource_version, arg_max(name, resource_version) AS name,
    (max(struct_pack(v := resource_version, s := status))).s AS status
FROM classified GROUP BY uid"""


def journal_resume(spark, sf):
    events = _events(spark, sf)
    # a journal entry three fifths into the stream; one row
    cursor = events.agg(F.floor(F.max("resource_version") * 3 / 5)).first()[0]
    resumed = jobs.classify_jobs(jobs.after_cursor(events, cursor))
    return resumed.groupBy("routing_key").agg(
        _count(),
        F.min("resource_version").alias("first_version"),
        F.max("resource_version").alias("cursor"),
    )


RESUME_SQL = classified_sql() + """
SELECT routing_key, count(*) AS events, min(resource_version) AS first_version, max(resource_version) AS cursor
FROM classified
WHERE resource_version > (SELECT CAST(floor(max(resource_version) * 3 / 5) AS BIGINT) FROM job_events)
GROUP BY 1"""


def first_run_position(spark, sf):
    events = _events(spark, sf)
    past = jobs.after_cursor(events, None).agg(_count("past_events"))
    start = jobs.snapshot_position(events)
    done = jobs.advance(jobs.watched_events(events)).withColumnRenamed("cursor", "processed_to")
    return past.select("past_events", start.scalar().alias("start_at"), done.scalar().alias("processed_to"))


FIRST_RUN_SQL = with_views("job_events", watched=WATCHED) + """
SELECT CAST(0 AS BIGINT) AS past_events, (SELECT max(resource_version) FROM job_events) AS start_at,
    (SELECT max(resource_version) FROM watched) AS processed_to"""


def journal_positions(spark, sf):
    return jobs.read_positions(view(spark, sf, "journal_texts")).select("event_id", "position", "purge")


POSITIONS_SQL = """
SELECT event_id, CASE event_id % 6 WHEN 0 THEN event_id WHEN 3 THEN event_id WHEN 4 THEN -event_id END AS position,
    event_id % 6 IN (1, 2) AS purge
FROM events"""

_KEPT = "ts >= TIMESTAMP '2024-01-08 00:00:00'"
_CURSORS = "CASE namespace WHEN 'ns0' THEN min(resource_version) WHEN 'ns1' THEN max(resource_version) - 10 END"


def event_horizon_gap(spark, sf):
    events = _events(spark, sf)
    cursors = events.groupBy("namespace").agg(F.expr(_CURSORS).alias("cursor"))
    return jobs.find_gap(events.where(_KEPT), cursors).select(
        "namespace", "cursor", "oldest", "newest", "gap", "resume_at"
    )


GAP_SQL = with_views(
    "job_events",
    cursors=f"SELECT namespace, {_CURSORS} AS cursor FROM job_events GROUP BY namespace",
    kept=f"SELECT namespace, min(resource_version) AS oldest, max(resource_version) AS newest FROM job_events WHERE {_KEPT} GROUP BY 1",
) + """
SELECT namespace, cursor, oldest, newest, coalesce(cursor < oldest - 1, false) AS gap,
    CASE WHEN cursor IS NULL OR cursor < oldest - 1 THEN newest ELSE cursor END AS resume_at
FROM cursors LEFT JOIN kept USING (namespace)"""


def newest_condition_reason(spark, sf):
    newest = jobs.newest_condition(
        view(spark, sf, "job_conditions"),
        keys=["job"],
        probe_time="last_probe_time",
        position=["n1", "n2", "n3", "reason", "message"],
        take=["reason", "message"],
    )
    return newest.select("job", st.reason_text(F.col("reason"), F.col("message")).alias("failure_reason"))


NEWEST_SQL = with_views("job_conditions") + """
SELECT job, reason || ' - ' || message AS failure_reason FROM job_conditions
QUALIFY row_number() OVER (PARTITION BY job ORDER BY last_probe_time DESC, n1, n2, n3, reason, message) = 1"""


def job_state_lookup(spark, sf):
    states = jobs.parse_state(view(spark, sf, "stored_states"))
    found = jobs.with_last_state(jobs.watched_events(_events(spark, sf)), states)
    return found.select("resource_version", "uid", "last_status", "last_seen")


LOOKUP_SQL = with_views("job_events", watched=WATCHED) + """
SELECT resource_version, uid, CASE WHEN c_custkey IS NOT NULL THEN 'running' END AS last_status, c_custkey + 0.5::DOUBLE AS last_seen
FROM watched LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 5 > 1) ON uid = 'uid-' || CAST(c_custkey AS VARCHAR)"""


def broken_states(spark, sf):
    return jobs.parse_state(view(spark, sf, "stored_states")).where("purge").select("uid")


BROKEN_SQL = "SELECT 'uid-' || CAST(c_custkey AS VARCHAR) AS uid FROM customer WHERE c_custkey % 5 <= 1"


def retry_schedule(spark, sf):
    failures = _events(spark, sf).where("active = 0").select("uid", "resource_version")
    return plan_retries(failures, ["uid"], "resource_version")


RETRY_SQL = with_views(
    "job_events",
    numbered="""SELECT uid, resource_version, row_number() OVER (PARTITION BY uid ORDER BY resource_version) AS attempt
        FROM job_events WHERE active = 0""",
) + """
SELECT uid, resource_version, attempt, attempt >= 10 AS exhausted,
    CASE WHEN attempt < 10 THEN attempt * 5 END AS publish_delay,
    CASE WHEN attempt < 10 THEN attempt * 2 END AS connect_delay,
    CAST(coalesce(sum(attempt * 5) OVER (PARTITION BY uid ORDER BY attempt
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS waited_before
FROM numbered"""

QUERIES = {
    "status_by_routing_key": (status_by_routing_key, STATUS_BY_KEY_SQL),
    "status_messages": (status_messages, STATUS_MESSAGES_SQL),
    "unclassified_events": (unclassified_events, UNCLASSIFIED_SQL),
    "suspect_failures": (suspect_failures, SUSPECT_SQL),
    "status_rules": (status_rules, STATUS_RULES_SQL),
    "skipped_events": (skipped_events, SKIPPED_SQL),
    "namespace_events": (namespace_events, NAMESPACE_SQL),
    "deduplicated_events": (deduplicated_events, DEDUPLICATED_SQL),
    "latest_job_state": (latest_job_state, LATEST_SQL),
    "journal_resume": (journal_resume, RESUME_SQL),
    "first_run_position": (first_run_position, FIRST_RUN_SQL),
    "journal_positions": (journal_positions, POSITIONS_SQL),
    "event_horizon_gap": (event_horizon_gap, GAP_SQL),
    "newest_condition_reason": (newest_condition_reason, NEWEST_SQL),
    "job_state_lookup": (job_state_lookup, LOOKUP_SQL),
    "broken_states": (broken_states, BROKEN_SQL),
    "retry_schedule": (retry_schedule, RETRY_SQL),
}
