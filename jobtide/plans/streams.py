"""Queries that run as streams and must agree with their batch twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from jobtide import fixed
from jobtide.operators import jobs, messages as mq
from jobtide.operators.numbering import number_rows, serial_slice
from jobtide.operators.reaping import pod_log_sizes
from jobtide.plans.adapters import table, view, with_views
from jobtide.plans.events import STATUS_BY_KEY_SQL, classified_sql
from jobtide.plans.launches import BASE_LABELS, BASE_PATH, TEMPLATE, existing_names, plan_sql
from jobtide.plans.messages import (
    JOBS,
    STATUS_HANDLER,
    UPLOAD_HANDLER,
    deliveries,
    statuses,
    uploads,
    verdicts_sql,
)
from jobtide.session import run_dir, written
from jobtide.sinks.files import compact_states, last_position, read_states, record_position, recover_position
from jobtide.sources.events import read_events, stream_events
from jobtide.sources.logfiles import read_pod_logs
from jobtide.sources.queue import from_kafka, stream_messages
from jobtide.streaming import delayed, launch as launches, runner, states, status, tail


def _watch_files(spark: SparkSession, sf: str) -> str:
    """The change events as files of nested watch JSON."""
    folder = run_dir(spark, "watch")
    metadata = F.struct(
        "uid", "name", "namespace", F.col("resource_version").cast("string").alias("resourceVersion")
    )
    counters = F.struct("active", "failed", "succeeded", F.col("start_time").alias("startTime"))
    view(spark, sf, "job_events").select(
        F.col("watch_type").alias("type"),
        F.struct(
            F.col("object_kind").alias("kind"), metadata.alias("metadata"), counters.alias("status")
        ).alias("object"),
    ).write.json(folder)
    return folder


def _broken_lines(spark: SparkSession, sf: str, folder: str) -> None:
    """Lines that are no watch events, in the same folder."""
    broken = table(spark, sf, "events").where("event_id % 50 = 0")
    text = F.when(F.col("event_id") % 100 == 0, F.concat(F.lit("{cut off "), F.col("event_id").cast("string"))).otherwise(F.lit("no event"))
    broken.select(text.alias("value")).write.mode("append").text(folder)


def event_accounting(spark, sf):
    """Every line of the change files is processed or skipped for a reason, broken lines too."""
    folder = _watch_files(spark, sf)
    _broken_lines(spark, sf, folder)
    why = F.coalesce(jobs.skip_reason(), F.lit("processed"))
    events = read_events(spark, folder)
    return events.groupBy(why.alias("skipped")).agg(
        F.count(F.lit(1)).alias("events"), F.count("broken_line").alias("broken_lines")
    )


ACCOUNTING_SQL = with_views("job_events") + """
SELECT CASE WHEN object_kind <> 'Job' THEN 'not_a_job' WHEN name NOT LIKE 'cds-%' THEN 'other_name'
    WHEN watch_type = 'DELETED' THEN 'deleted' ELSE 'processed' END AS skipped, count(*) AS events, CAST(0 AS BIGINT) AS broken_lines
FROM job_events GROUP BY 1
UNION ALL SELECT 'malformed', count(*), count(*) FROM events WHERE event_id % 50 = 0"""


def stream_equals_batch(spark, sf):
    """Status messages published by a stream, counted by routing key; every change is delivered twice."""
    folder = _watch_files(spark, sf)
    _broken_lines(spark, sf, folder)
    watch = spark.read.text(folder)
    twice = run_dir(spark, "watch-again")
    for _ in range(2):
        watch.write.mode("append").text(twice)
    out = run_dir(spark, "status-out")
    status.run_status_stream(stream_events(spark, twice), run_dir(spark, "checkpoint"), out).awaitTermination()
    body = F.from_json("value", "`job-name` STRING, `retry-count` BIGINT")
    published = spark.read.text(out).select("routing_key", body.alias("m"))
    return published.groupBy("routing_key").agg(
        F.count(F.lit(1)).alias("events"),
        F.countDistinct("m.job-name").alias("jobs"),
        F.sum("m.retry-count").cast("bigint").alias("retries"),
    )


def state_stream(spark, sf):
    """Latest state per job kept by a stream; jobs deleted last are gone."""
    events = stream_events(spark, _watch_files(spark, sf), max_files=1)
    root = run_dir(spark, "states")
    status.run_state_stream(events, run_dir(spark, "checkpoint"), root).awaitTermination()
    return read_states(spark, root)


def state_compaction(spark, sf):
    """States of a first half, compacted; then the rest and late old changes by a stream with a new checkpoint."""
    everything = read_events(spark, _watch_files(spark, sf))
    middle = everything.agg(F.percentile_approx("resource_version", 0.5)).first()[0]
    parts = {"first": F.col("resource_version") <= middle, "second": (F.col("resource_version") > middle) | (F.col("resource_version") % 3 == 0)}
    roots = {name: run_dir(spark, f"states-{name}") for name in parts}
    shape = "resource_version BIGINT, watch_type STRING, object_kind STRING, uid STRING, name STRING, namespace STRING, active INT, failed INT, succeeded INT, start_time TIMESTAMP"
    columns = [c.split()[0] for c in shape.split(", ")]
    for name, part in parts.items():
        folder = run_dir(spark, f"events-{name}")
        everything.where(part).select(*columns).write.parquet(folder)
        if name == "second":
            compact_states(spark, roots["first"], roots["second"])
        stream = spark.readStream.schema(shape).parquet(folder)
        status.run_state_stream(stream, run_dir(spark, "checkpoint"), roots[name]).awaitTermination()
    return read_states(spark, roots["second"])


def journal_roundtrip(spark, sf):
    """The journal from writing a position to its loss: resumed, then cleared because the events are gone."""
    events, root = view(spark, sf, "job_events"), run_dir(spark, "journal")
    middle = events.agg(F.floor(F.max("resource_version") / 2).cast("bigint")).first()[0]
    record_position(spark, root, 1, middle)
    steps = [("resumed", recover_position(spark, root, events, 2))]
    # what is kept begins well behind the position
    kept = events.where(F.col("resource_version") > middle + 10)
    steps.append(("restarted", recover_position(spark, root, kept, 2)))
    steps.append(("cleared", last_position(spark, root).first()["position"]))
    record_position(spark, root, 3, steps[1][1])
    steps.append(("written", last_position(spark, root).first()["position"]))
    return spark.createDataFrame(steps, "step STRING, position BIGINT")


JOURNAL_SQL = """
WITH p AS (SELECT max(event_id) + 1 AS newest, (max(event_id) + 1) // 2 AS middle FROM events)
SELECT 'resumed' AS step, CAST(middle AS BIGINT) AS position FROM p UNION ALL SELECT 'restarted', newest FROM p
UNION ALL SELECT 'cleared', NULL FROM p UNION ALL SELECT 'written', newest FROM p"""


STATE_SQL = classified_sql(
    entries="""SELECT uid, resource_version, name, status, false AS deleted FROM classified
        UNION ALL SELECT uid, resource_version, name, NULL, true FROM job_events
        WHERE object_kind = 'Job' AND watch_type = 'DELETED'""",
) + """
SELECT uid, resource_version, name, status FROM entries
QUALIFY row_number() OVER (PARTITION BY uid ORDER BY resource_version DESC) = 1 AND NOT deleted"""


def _message_files(messages: DataFrame, spark: SparkSession) -> str:
    folder = run_dir(spark, "messages")
    messages.write.parquet(folder)
    return folder


def message_stream(spark, sf):
    """Messages processed by a stream: verdicts, and rejected ones with their bodies."""
    incoming = _message_files(deliveries(spark, sf), spark)
    root = run_dir(spark, "stream")
    stream = stream_messages(spark, [incoming])
    handlers = [UPLOAD_HANDLER, STATUS_HANDLER]
    runner.run_stream(stream, handlers, run_dir(spark, "checkpoint"), root).awaitTermination()
    verdicts = spark.read.parquet(f"{root}/{runner.VERDICTS}")
    dead = spark.read.parquet(f"{root}/{runner.DEAD_LETTERS}").select(
        "handler", F.lit("body kept").alias("disposition"), "reason"
    )
    return (
        verdicts.select("handler", "disposition", "reason")
        .unionByName(dead)
        .groupBy("handler", "disposition", "reason")
        .agg(F.count(F.lit(1)).alias("messages"))
    )


MESSAGE_STREAM_SQL = verdicts_sql() + """
SELECT handler, disposition, reason, count(*) AS messages FROM (
    SELECT handler, disposition, reason FROM verdicts
    UNION ALL SELECT handler, 'body kept', reason FROM verdicts WHERE disposition = 'dead_letter')
GROUP BY ALL"""

_PATIENCE = 3


def _not_yet(valid: DataFrame) -> DataFrame:
    """Succeeds on the attempt that follows from the message, asks for a retry before."""
    wait = F.col("attempt") <= F.col("delivery_id") % 4
    return valid.withColumns(
        {
            "disposition": F.when(wait, mq.REQUEUE).otherwise(mq.ACK),
            "reason": F.when(wait, "not_yet"),
        }
    )


def retry_stream(spark, sf):
    """Requeued messages come back until they succeed or their attempts are used up."""
    incoming = _message_files(statuses(spark, sf), spark)
    root, checkpoint = run_dir(spark, "stream"), run_dir(spark, "checkpoint")
    handler = mq.Handler("patient", JOBS, fixed.STATUS_PATTERN, fixed.STATUS_SCHEMA, _not_yet)
    retry = f"{root}/{runner.RETRY}"
    # the folder has to exist before the first message is put back
    statuses(spark, sf).where(F.lit(False)).write.parquet(f"{retry}/start")
    for _ in range(_PATIENCE):
        stream = stream_messages(spark, [incoming, retry])
        runner.run_stream(stream, [handler], checkpoint, root, _PATIENCE).awaitTermination()
    verdicts = spark.read.parquet(f"{root}/{runner.VERDICTS}")
    return verdicts.groupBy(F.col("attempt").cast("bigint").alias("attempt"), "disposition", "reason").agg(
        F.count(F.lit(1)).alias("messages")
    )


RETRY_STREAM_SQL = verdicts_sql(
    tried="""SELECT unnest(range(1, 1 + least(3, 1 + delivery_id % 4))) AS attempt, delivery_id
        FROM verdicts WHERE handler = 'statuses' AND disposition = 'ack'"""
) + """
SELECT CAST(attempt AS BIGINT) AS attempt,
    CASE WHEN attempt > delivery_id % 4 THEN 'ack' WHEN attempt < 3 THEN 'requeue' ELSE 'dead_letter' END AS disposition,
    CASE WHEN attempt > delivery_id % 4 THEN NULL WHEN attempt < 3 THEN 'not_yet' ELSE 'attempts_exhausted' END AS reason,
    count(*) AS messages
FROM tried GROUP BY ALL
UNION ALL
SELECT 1, 'dead_letter', reason, count(*) FROM verdicts WHERE handler = 'statuses' AND disposition = 'dead_letter' GROUP BY reason"""


def delayed_retries(spark, sf):
    """Requeued messages come back 5 seconds later for each attempt, on a clock that goes in steps of 5 seconds."""
    incoming = _message_files(statuses(spark, sf), spark)
    root, checkpoint = run_dir(spark, "stream"), run_dir(spark, "checkpoint")
    handler = mq.Handler("patient", JOBS, fixed.STATUS_PATTERN, fixed.STATUS_SCHEMA, _not_yet)
    releases = f"{root}/{delayed.RELEASES}"
    statuses(spark, sf).where(F.lit(False)).write.parquet(f"{releases}/start")
    clock = {}
    for now in (0, 5, 10, 15, 20):
        delayed.release_due(spark, root, now - 5, now)
        stream = stream_messages(spark, [incoming, releases])
        delayed.run_delayed_stream(stream, [handler], checkpoint, root, now, _PATIENCE).awaitTermination()
        done = spark.read.parquet(f"{root}/{runner.VERDICTS}").agg(F.max("batch")).first()[0]
        clock.setdefault(done, now)
    verdicts = spark.read.parquet(f"{root}/{runner.VERDICTS}")
    times = F.create_map(*[F.lit(x) for pair in clock.items() for x in pair])
    seconds = F.element_at(times, F.col("batch").cast("int")).cast("bigint")
    return verdicts.groupBy(F.col("attempt").cast("bigint").alias("attempt"), "disposition", "reason", seconds.alias("seconds")).agg(
        F.count(F.lit(1)).alias("messages")
    )


DELAYED_SQL = f"""
SELECT attempt, disposition, reason, messages, CAST(5 * attempt * (attempt - 1) // 2 AS BIGINT) AS seconds FROM ({RETRY_STREAM_SQL})"""


def state_lookup_stream(spark, sf):
    """Each change next to the last recorded state of its job, over four batches; states are kept from batch to batch."""
    events = view(spark, sf, "job_events")
    shape = "resource_version BIGINT, watch_type STRING, object_kind STRING, uid STRING, name STRING, namespace STRING, active INT, failed INT, succeeded INT, start_time TIMESTAMP"
    newest = events.agg(F.max("resource_version")).first()[0]
    folder, root, checkpoint = run_dir(spark, "events"), run_dir(spark, "states"), run_dir(spark, "checkpoint")
    quarter = F.least(F.floor(F.col("resource_version") * 4 / (newest + 1)), F.lit(3))
    for part in range(4):
        events.where(quarter == part).select(*[c.split()[0] for c in shape.split(", ")]).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(shape).parquet(folder)
        states.run_lookup_stream(stream, checkpoint, root).awaitTermination()
    looked = spark.read.parquet(f"{root}/{states.LOOKED_UP}")
    return looked.select("resource_version", "uid", "status", "deleted", "last_status")


LOOKUP_STREAM_SQL = classified_sql(
    entries="""SELECT uid, resource_version, name, status, false AS deleted FROM classified
        UNION ALL SELECT uid, resource_version, name, NULL, true FROM job_events
        WHERE object_kind = 'Job' AND watch_type = 'DELETED'""",
) + """
SELECT resource_version, uid, status, deleted, CASE WHEN NOT lag(deleted) OVER w THEN lag(status) OVER w END AS last_status
FROM entries WINDOW w AS (PARTITION BY uid ORDER BY resource_version)"""


def launch_stream(spark, sf):
    """Launches planned by a stream in several batches: names as if they had come at once."""
    arriving = uploads(spark, sf)
    newest = arriving.agg(F.max("delivery_id")).first()[0]
    folder, root, checkpoint = run_dir(spark, "messages"), run_dir(spark, "launches"), run_dir(spark, "checkpoint")
    third = F.least(F.floor(F.col("delivery_id") * 3 / (newest + 1)), F.lit(2))
    for part in range(3):
        arriving.where(third == part).write.mode("append").parquet(folder)
        launches.run_launch_stream(
            stream_messages(spark, [folder]),
            UPLOAD_HANDLER,
            checkpoint,
            root,
            BASE_PATH,
            "ns",
            existing=existing_names(spark, sf),
            base_labels=BASE_LABELS,
            template=TEMPLATE,
        ).awaitTermination()
    read = lambda folder: spark.read.parquet(f"{root}/{folder}")
    verdicts = read(runner.VERDICTS).select("delivery_id", "disposition", "reason")
    outcomes = read(runner.OUTCOMES).select("delivery_id", F.col("routing_key").alias("outcome_key"))
    plans = read(launches.PLANS).select("delivery_id", "job_name", "metadata_path")
    files = read(launches.METADATA).select("metadata_path", F.length("content").cast("bigint").alias("characters"))
    return (
        verdicts.join(outcomes, "delivery_id", "left").join(plans, "delivery_id", "left").join(files, "metadata_path", "left")
    )


LAUNCH_STREAM_SQL = plan_sql() + f"""
SELECT v.delivery_id, CASE WHEN p.reason IS NOT NULL THEN 'dead_letter' ELSE v.disposition END AS disposition, coalesce(p.reason, v.reason) AS reason,
    CASE WHEN p.reason IS NOT NULL OR v.reason = 'xml' THEN 'cds.job.invalid' WHEN p.delivery_id IS NOT NULL THEN 'cds.job.started' END AS outcome_key,
    CASE WHEN p.reason IS NULL THEN p.job_name END AS job_name,
    CASE WHEN p.reason IS NULL AND p.delivery_id IS NOT NULL THEN '/data/metadata/' || p.target_name || '.inmeta' END AS metadata_path,
    CASE WHEN p.reason IS NULL AND p.delivery_id IS NOT NULL
        THEN CAST(length(regexp_extract(p.body, '"inmeta":"([^"]*)"', 1)) AS BIGINT) END AS characters
FROM (SELECT * FROM verdicts WHERE handler_name = 'uploads') v LEFT JOIN planned p USING (delivery_id)"""


def reap_stream(spark, sf):
    """Pod logs archived by a stream as the status messages of their jobs arrive, some of them twice."""
    lines = view(spark, sf, "pod_lines")
    key = F.expr("'cds.job.' || CASE job_number % 3 WHEN 0 THEN 'failed' WHEN 1 THEN 'success' ELSE 'running' END")
    body = F.to_json(F.struct(F.concat(F.lit("uid-"), "job_name").alias("job-id"), F.col("job_name").alias("job-name"), F.col("job_namespace").alias("job-namespace")))
    states = lines.select(
        F.lit(JOBS).alias("exchange"), key.alias("routing_key"), F.col("job_number").alias("delivery_id"), body.cast("binary").alias("body"), F.lit(1).alias("attempt")
    ).distinct()
    folder, root, archive = (run_dir(spark, n) for n in ("messages", "reaped", "archive"))
    states.coalesce(1).write.parquet(folder)
    states.where("delivery_id % 2 = 0").coalesce(1).write.mode("append").parquet(folder)
    launches.run_reap_stream(
        stream_messages(spark, [folder], max_files=1),
        STATUS_HANDLER,
        run_dir(spark, "checkpoint"),
        root,
        lambda: lines.select("job_namespace", "job_name", "pod_name").distinct(),
        lambda: lines.select("job_namespace", "pod_name", "line_no", "line"),
        archive,
    ).awaitTermination()
    back = read_pod_logs(spark, archive)
    sizes = pod_log_sizes(back.withColumn("job_namespace", F.lit("ns0"))).withColumnRenamed("lines", "line_count")
    jobs_of = back.select("pod_name", "job_name").distinct()
    actions = spark.read.parquet(f"{root}/{launches.ACTIONS}").select("job_name", "action").distinct()
    return sizes.join(jobs_of, "pod_name").join(actions, "job_name").select("job_name", "pod_name", "log_size", "line_count", "action")


REAP_STREAM_SQL = with_views("pod_lines") + """
SELECT job_name, pod_name, CAST(sum(length(line) + 1) AS BIGINT) AS log_size, count(*) AS line_count, 'archive+delete' AS action
FROM pod_lines WHERE job_number % 3 < 2 GROUP BY 1, 2"""


def kafka_deliveries(spark, sf):
    """The same messages as records of a topic, through the reader of such records."""
    given = uploads(spark, sf)
    records = given.select(
        F.col("exchange").alias("topic"),
        F.col("routing_key").cast("binary").alias("key"),
        F.col("body").alias("value"),
        (F.col("delivery_id") % 8).cast("int").alias("partition"),
        F.floor(F.col("delivery_id") / 8).alias("offset"),
    )
    done = mq.process(from_kafka(records), [UPLOAD_HANDLER, STATUS_HANDLER])
    place = F.expr("shiftright(delivery_id, 48) + (delivery_id & ((1L << 48) - 1)) * 8")
    return done.select(place.alias("delivery_id"), "handler", "disposition", "reason")


KAFKA_SQL = verdicts_sql() + """
SELECT delivery_id, handler, disposition, reason FROM verdicts WHERE handler_name = 'uploads'"""


def tail_stream(spark, sf):
    """Two looks at a folder of logs, with more files in between."""
    base, root = run_dir(spark, "logs"), run_dir(spark, "tail")
    lines = view(spark, sf, "tail_lines").select("route", F.expr("replace(line, chr(10), ' ')").alias("line"), "line_no")
    for look, part in enumerate(("line_no < 2", "line_no >= 2")):
        lines.where(part).select("route", "line").write.mode("append").partitionBy("route").text(base)
        tail.tail_once(spark, base, root, look)
    seen = spark.read.parquet(f"{root}/lines")
    return seen.groupBy(
        F.regexp_replace("route", "^route=", "").alias("route"), F.col("look").cast("bigint").alias("look")
    ).agg(F.count(F.lit(1)).alias("lines"), F.sum(F.length("line")).cast("bigint").alias("characters"))


TAIL_STREAM_SQL = with_views("tail_lines") + """
SELECT route, CAST(CASE WHEN line_no < 2 THEN 0 ELSE 1 END AS BIGINT) AS look, count(*) AS lines,
    CAST(sum(length(line)) AS BIGINT) AS characters FROM tail_lines GROUP BY 1, 2"""

# pieces of a log up to which each look sees it: an even count ends behind a line, an odd one inside
_SEEN = {
    0: "CASE route WHEN 'src1' THEN 0 ELSE 2 * (pieces div 6) + 1 END",
    1: "CASE route WHEN 'src2' THEN 2 * (pieces div 6) + 1 ELSE 2 * (pieces div 3) + 1 END",
    2: "pieces",
}


def tail_growth(spark, sf):
    """Logs that grow in the middle of a line, one that comes late with an old time, one left alone for a while.

    A log has two pieces per text, each followed by a blank; the second one ends its line.  So every
    state of a log is the beginning of its last one.
    """
    base, root, hadoop = run_dir(spark, "growing"), run_dir(spark, "tail"), spark.sparkContext._jvm.org.apache.hadoop.fs
    text = F.regexp_replace("text", "\n", " ")
    cut = F.floor(F.length(text) / 2).cast("int")
    halves = F.array(F.substring(text, F.lit(1), cut), F.concat(F.substring(text, cut + 1, F.length(text)), F.lit("\n")))
    documents = table(spark, sf, "documents")
    totals = documents.groupBy(F.col("source").alias("route")).agg((F.count(F.lit(1)) * 2).alias("pieces"))
    numbered = number_rows(documents.select(F.col("source").alias("route"), "doc_id", halves.alias("halves")), ["route"], ["doc_id"], serial_slice("doc_id"), "rank")
    pieces = numbered.select("route", "rank", F.posexplode("halves").alias("half", "piece")).withColumn("place", F.col("rank") * 2 + F.col("half")).join(totals, "route")
    pieces = written(pieces, "pieces")
    system = hadoop.Path(base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for look, seen in _SEEN.items():
        state = run_dir(spark, "state")
        visible = pieces.where(F.expr(f"place < {seen}")).repartition("route").sortWithinPartitions("route", "place")
        visible.select("route", "piece").write.option("lineSep", " ").partitionBy("route").text(state)
        made = spark.read.option("recursiveFileLookup", True).text(state).select(F.col("_metadata.file_path").alias("path")).distinct()
        for row in made.collect():  # one file per route
            source = hadoop.Path(row["path"])
            folder = hadoop.Path(base, source.getParent().getName().removeprefix("route="))
            target = hadoop.Path(folder, "app.log")
            system.mkdirs(folder)
            if system.exists(target):
                if system.getFileStatus(target).getLen() == system.getFileStatus(source).getLen():
                    continue
                system.delete(target, False)
            system.rename(source, target)
            if folder.getName() == "src1":
                system.setTimes(target, 1_000_000_000_000, -1)  # the clock of its host is years behind
        tail.tail_once(spark, base, root, look)
    lines = spark.read.parquet(f"{root}/lines")
    return lines.select("route", "line_no", F.md5("line").alias("line_md5"))


TAIL_GROWTH_SQL = """
WITH t AS (SELECT source AS route, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS line_no, replace(text, chr(10), ' ') AS x FROM documents)
SELECT route, line_no, md5(CASE WHEN line_no = 0 THEN '' ELSE ' ' END || left(x, CAST(length(x) // 2 AS INT)) || ' ' || substr(x, CAST(length(x) // 2 AS INT) + 1)) AS line_md5 FROM t"""

QUERIES = {
    "event_accounting": (event_accounting, ACCOUNTING_SQL),
    "state_compaction": (state_compaction, STATE_SQL),
    "journal_roundtrip": (journal_roundtrip, JOURNAL_SQL),
    "launch_stream": (launch_stream, LAUNCH_STREAM_SQL),
    "reap_stream": (reap_stream, REAP_STREAM_SQL),
    "kafka_deliveries": (kafka_deliveries, KAFKA_SQL),
    "tail_growth": (tail_growth, TAIL_GROWTH_SQL),
    "stream_equals_batch": (stream_equals_batch, STATUS_BY_KEY_SQL),
    "state_stream": (state_stream, STATE_SQL),
    "message_stream": (message_stream, MESSAGE_STREAM_SQL),
    "retry_stream": (retry_stream, RETRY_STREAM_SQL),
    "delayed_retries": (delayed_retries, DELAYED_SQL),
    "state_lookup_stream": (state_lookup_stream, LOOKUP_STREAM_SQL),
    "tail_stream": (tail_stream, TAIL_STREAM_SQL),
}
