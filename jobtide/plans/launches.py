"""Queries over launch planning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from jobtide import fixed
from jobtide.functions import names
from jobtide.operators import jobs, launch, messages as mq, naming
from jobtide.operators.once import evaluate_once
from jobtide.operators.spread import spread
from jobtide.plans.adapters import table, view, with_views
from jobtide.plans.events import CLASSIFIED, WATCHED, events_with_conditions
from jobtide.plans.messages import REQUESTS, UPLOAD_HANDLER, uploads, verdicts_sql
from jobtide.session import run_dir
from jobtide.sinks.files import write_metadata

BASE_PATH = "/data/metadata"
BASE_LABELS = {"app": "delivery", "online-id": "from-template"}
_TAKEN_SUFFIXES = ("", "-2", "-5")


def _sql_clean(text: str, limit: int = 59) -> str:
    dashed = f"regexp_replace({text}, '\\s+', '-', 'g')"
    kept = f"lower(regexp_replace({dashed}, '[^A-Za-z0-9-]', '', 'g'))"
    return f"regexp_replace(regexp_replace(left({kept}, {limit}), '[^a-z0-9]+$', ''), '^[^a-z0-9]+', '')"


def _sql_label(text: str) -> str:
    kept = f"regexp_replace({text}, '[^A-Za-z0-9\\-_.]', '', 'g')"
    return f"CASE WHEN length({kept}) < 63 THEN {kept} ELSE left({kept}, 60) || '...' END"


def _sql_allocated(requests: str, taken_names: str) -> dict[str, str]:
    """Named queries that list the free slots of each stem and deal them out in order."""
    numbered = "regexp_extract(name, '^(.*)-([1-9][0-9]{0,2})$', %d)"
    slots = (
        "SELECT name AS stem, 0 AS slot FROM taken_names UNION "
        f"SELECT {numbered % 1}, CAST({numbered % 2} AS INT) FROM (SELECT name FROM taken_names UNION SELECT stem FROM requests)"
        " WHERE regexp_matches(name, '^(.*)-([1-9][0-9]{0,2})$')"
    )
    return {
        "requests": requests,
        "taken_names": taken_names,
        "taken": f"SELECT stem, slot FROM ({slots})",
        "per_stem": """SELECT r.stem, r.n + coalesce(t.n, 0) AS enough
            FROM (SELECT stem, count(*) AS n FROM requests GROUP BY 1) r
            LEFT JOIN (SELECT stem, count(*) AS n FROM taken GROUP BY 1) t USING (stem)""",
        "candidates": "SELECT stem, CAST(unnest(range(least(1000, enough))) AS INT) AS slot FROM per_stem",
        "free": """SELECT stem, slot, row_number() OVER (PARTITION BY stem ORDER BY slot) AS k
            FROM candidates ANTI JOIN taken USING (stem, slot)""",
        "ranked": "SELECT *, row_number() OVER (PARTITION BY stem ORDER BY delivery_id) AS k FROM requests",
        "allocated": """SELECT ranked.*, slot, CASE WHEN slot = 0 THEN stem ELSE stem || '-' || CAST(slot AS VARCHAR) END AS target_name
            FROM ranked LEFT JOIN free USING (stem, k)""",
    }


# --- whole launch plans ------------------------------------------------------------------


def existing_names(spark: SparkSession, sf: str) -> DataFrame:
    """Names in use: the plain name and two numbered ones of each clip."""
    clip = F.concat(F.lit("clip-"), (F.col("o_custkey") % 50).cast("string"), F.lit("-takemxf"))
    return (
        table(spark, sf, "orders")
        .select(clip.alias("clip"))
        .distinct()
        .select(F.explode(F.array(*[F.concat("clip", F.lit(s)) for s in _TAKEN_SUFFIXES])).alias("name"))
    )


def _plan(spark: SparkSession, sf: str) -> DataFrame:
    routed = uploads(spark, sf).where(mq.fits(UPLOAD_HANDLER.binding))
    checked = launch.check_metadata(mq.validate(routed, fixed.UPLOAD_SCHEMA))
    valid = checked.where(F.col("disposition") == mq.ACK).drop("metadata_pairs", "metadata_type", "movie_tokens")
    return launch.plan_launches(valid, existing_names(spark, sf), BASE_PATH, "ns", BASE_LABELS)


_FILENAME = """CASE WHEN d % 8 = 2 THEN '' WHEN d % 8 IN (3, 6, 7) THEN 'Clip ' || CAST(c % 50 AS VARCHAR) || ' take.mxf' END"""
_ONLINE = "CASE WHEN d % 3 = 2 THEN 'KP-' || CAST(c AS VARCHAR) END"
_NEARLINE = """CASE WHEN d % 5 >= 2 THEN 'a very long name of the nearline store item that goes on and on until it is cut ' || CAST(d AS VARCHAR) END"""
_ARCHIVE = "CASE WHEN d % 7 >= 2 THEN 'AR ' || CAST(d AS VARCHAR) END"
_DIGITS = "0123456789abcdefghijklmnopqrstuvwxyz"


def _sql_token(digest: str, length: int) -> str:
    """Digits in base 36 of the first 60 bits, the last ones of them."""
    number = f"CAST('0x' || left({digest}, 15) AS BIGINT)"
    digits = [f"substr('{_DIGITS}', CAST(({number} // {36**i}) % 36 AS INT) + 1, 1)" for i in reversed(range(length))]
    return " || ".join(digits)


_DIGEST = "sha256(exchange || '|' || routing_key || '|' || body || '|' || CAST(delivery_id AS VARCHAR))"
_REQUESTS = f"""SELECT *, {_sql_clean('hint')} AS stem FROM (
    SELECT v.*, f.* EXCLUDE (d), coalesce(filename, online_id, nearline_id, archive_id, {_sql_token(_DIGEST, 10)}) AS hint,
        {_sql_token(_DIGEST, 4)} AS suffix
    FROM (SELECT * FROM verdicts WHERE handler = 'uploads' AND disposition = 'ack') v
    JOIN (SELECT d, c, {_FILENAME} AS filename, {_ONLINE} AS online_id, {_NEARLINE} AS nearline_id, {_ARCHIVE} AS archive_id
        FROM (SELECT o_orderkey AS d, o_custkey AS c FROM orders)) f ON v.delivery_id = f.d)"""
_TAKEN_NAMES = """SELECT DISTINCT 'clip-' || CAST(o_custkey % 50 AS VARCHAR) || '-takemxf' || s AS name
    FROM orders, (VALUES (''), ('-2'), ('-5')) AS t(s)"""
_WHOLE = "'cds-' || hint || '-' || suffix"
_HEAD = _sql_clean("'cds-' || hint", 49)
_JOB_NAME = (
    f"CASE WHEN row_number() OVER (PARTITION BY {_HEAD}, suffix ORDER BY delivery_id) > 1 THEN {_HEAD} || '-' || suffix || '-'"
    f" || row_number() OVER (PARTITION BY {_HEAD}, suffix ORDER BY delivery_id)"
    f" WHEN length({_sql_clean(_WHOLE, 1000000)}) <= 59 THEN {_sql_clean(_WHOLE)}"
    f" ELSE {_sql_clean(chr(39) + 'cds-' + chr(39) + ' || hint', 54)} || '-' || suffix END"
)
_PLANNED = f"""SELECT * EXCLUDE (reason, disposition), {_JOB_NAME} AS job_name,
        CASE WHEN stem = '' THEN 'blank_name' WHEN target_name IS NULL THEN 'no_free_name' END AS reason
    FROM allocated"""
_PATH = "'/data/metadata/' || target_name || '.inmeta'"
_LABELS = {
    "deliverable-asset-id": "CAST(delivery_id AS VARCHAR)",
    "deliverable-bundle-id": "CAST(c AS VARCHAR)",
    "online-id": f"coalesce({_sql_label('online_id')}, 'None')",
    "nearline-id": f"coalesce({_sql_label('nearline_id')}, 'None')",
    "archive-id": f"coalesce({_sql_label('archive_id')}, 'None')",
}


def plan_sql(**more: str) -> str:
    return verdicts_sql(**_sql_allocated(_REQUESTS, _TAKEN_NAMES), planned=_PLANNED, **more)


def launch_plan(spark, sf):
    return _plan(spark, sf).select(
        "delivery_id",
        "disposition",
        "reason",
        "hint",
        "job_name",
        "metadata_path",
        F.array_join("command", " ").alias("command"),
        *[F.col("labels")[k].alias(f"label_{k.replace('-', '_')}") for k in ("app", *fixed.LABELS)],
    )


LAUNCH_SQL = plan_sql() + f"""
SELECT delivery_id, CASE WHEN reason IS NULL THEN 'ack' ELSE 'dead_letter' END AS disposition, reason, hint, job_name,
    CASE WHEN reason IS NULL THEN {_PATH} END AS metadata_path,
    CASE WHEN reason IS NULL THEN '/usr/local/bin/cds_run.pl --input-inmeta ' || {_PATH} || ' --route route-'
        || CAST(c % 7 AS VARCHAR) || '.xml' END AS command,
    'delivery' AS label_app, {", ".join(f"{sql} AS label_{k.replace('-', '_')}" for k, sql in _LABELS.items())}
FROM planned"""


def repeated_job_names(spark, sf):
    """Launches, their different job names and their different metadata files: three equal numbers."""
    started = _plan(spark, sf)
    return started.agg(
        F.count(F.lit(1)).alias("launches"),
        F.countDistinct("job_name").alias("job_names"),
        (F.countDistinct("metadata_path") + F.count(F.when(F.col("reason").isNotNull(), 1))).alias("files"),
    )


REPEATED_SQL = verdicts_sql() + """
SELECT count(*) AS launches, count(*) AS job_names, count(*) AS files FROM verdicts WHERE handler = 'uploads' AND disposition = 'ack'"""

TEMPLATE = {
    "apiVersion": "batch/v1",
    "metadata": {"namespace": "ns", "annotations": {"owner": "media team"}, "labels": {"app": "template", "team": "media"}},
    "spec": {
        "backoffLimit": 2,
        "template": {
            "spec": {
                "serviceAccountName": "runner",
                "containers": [
                    {
                        "name": "worker",
                        "image": "registry/worker:1",
                        "env": [{"name": "LEVEL", "value": "info"}],
                        "volumeMounts": [{"name": "media", "mountPath": "/media"}],
                        "resources": {"limits": {"cpu": 1}},
                    },
                    {"name": "side", "image": "registry/side:1"},
                ],
                "volumes": [{"name": "media", "emptyDir": {}}],
                "restartPolicy": "Never",
            }
        },
    },
}


def launch_documents(spark, sf):
    """Job manifests: the whole template, overlaid by the plan."""
    started = _plan(spark, sf).where(F.col("status") == fixed.STARTED)
    return started.select("delivery_id", launch.job_document(TEMPLATE).alias("document"))


_LABEL_JSON = " || ',' || ".join(
    ["'\"team\":\"media\"'", "'\"app\":\"delivery\"'"]
    + [
        f"'\"{k}\":\"' || {sql} || '\"'"
        for k, sql in [
            ("online-id", _LABELS["online-id"]),
            *[(k, v) for k, v in _LABELS.items() if k != "online-id"],
        ]
    ]
)
DOCUMENTS_SQL = plan_sql() + f"""
SELECT delivery_id, '{{"apiVersion":"batch/v1","metadata":{{"namespace":"ns","annotations":{{"owner":"media team"}},"labels":{{'
    || {_LABEL_JSON} || '}},"name":"' || job_name || '"}},"spec":{{"backoffLimit":2,"template":{{"spec":{{"serviceAccountName":"runner","containers":['
    || '{{"name":"worker","image":"registry/worker:1","env":[{{"name":"LEVEL","value":"info"}}],"volumeMounts":[{{"name":"media","mountPath":"/media"}}],'
    || '"resources":{{"limits":{{"cpu":1}}}},"command":["/usr/local/bin/cds_run.pl","--input-inmeta","' || {_PATH} || '","--route","route-'
    || CAST(c % 7 AS VARCHAR) || '.xml"]}},{{"name":"side","image":"registry/side:1"}}],"volumes":[{{"name":"media","emptyDir":{{}}}}],'
    || '"restartPolicy":"Never"}}}}}},"kind":"Job"}}' AS document
FROM planned WHERE reason IS NULL"""


def launch_outcomes(spark, sf):
    # the cluster gives a started job its id; here it follows from the delivery
    planned = _plan(spark, sf).withColumn("job_id", F.concat(F.lit("uid-"), F.col("delivery_id").cast("string")))
    return launch.launch_outcomes(planned).select("delivery_id", "outcome_key", "outcome_body")


OUTCOMES_SQL = plan_sql() + """
SELECT delivery_id, CASE WHEN reason IS NULL THEN 'cds.job.started' ELSE 'cds.job.invalid' END AS outcome_key,
    left(body, length(body) - 1) || CASE WHEN reason IS NULL
        THEN ',"job-id":"uid-' || CAST(delivery_id AS VARCHAR) || '","job-name":"' || job_name || '","job-namespace":"ns"}'
        ELSE ',"job-name":"' || job_name || '","error":"cannot launch: ' || reason || '"}' END AS outcome_body
FROM planned"""


def outcome_union(spark, sf):
    """Launch outcomes and job status messages as one stream of messages."""
    outcomes = launch.launch_outcomes(_plan(spark, sf)).select(
        F.col("outcome_key").alias("routing_key"), "job_name", "error"
    )
    messages = jobs.status_messages(jobs.classify_jobs(events_with_conditions(spark, sf))).select(
        "routing_key", "job_name", "failure_reason"
    )
    both = outcomes.unionByName(messages, allowMissingColumns=True)
    return both.groupBy("routing_key").agg(
        F.count(F.lit(1)).alias("messages"),
        F.count("error").alias("errors"),
        F.count("failure_reason").alias("failures"),
    )


UNION_SQL = verdicts_sql(
    **_sql_allocated(_REQUESTS, _TAKEN_NAMES),
    planned=_PLANNED,
    job_events=with_views("job_events").split("AS (", 1)[1].rsplit(")", 1)[0],
    watched=WATCHED,
    classified=CLASSIFIED,
) + """
SELECT CASE WHEN reason IS NULL THEN 'cds.job.started' ELSE 'cds.job.invalid' END AS routing_key,
    count(*) AS messages, count(reason) AS errors, CAST(0 AS BIGINT) AS failures
FROM planned GROUP BY 1
UNION ALL
SELECT routing_key, count(*), 0, count(*) FILTER (WHERE status = 'failed') FROM classified GROUP BY 1"""


def metadata_files(spark, sf):
    """Metadata documents written under their target names, twice, and read back."""
    folder = run_dir(spark, "metadata")
    started = _plan(spark, sf).where(F.col("status") == fixed.STARTED)
    for _ in range(2):
        write_metadata(started, folder, "one")
    return spark.read.parquet(folder).groupBy(F.col("routename").alias("route")).agg(
        F.countDistinct("metadata_path").alias("files"),
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.length("content")).cast("bigint").alias("characters"),
    )


FILES_SQL = plan_sql() + """
SELECT 'route-' || CAST(c % 7 AS VARCHAR) || '.xml' AS route, count(*) AS files, count(*) AS rows,
    CAST(sum(length(regexp_extract(body, '"inmeta":"([^"]*)"', 1))) AS BIGINT) AS characters
FROM planned WHERE reason IS NULL GROUP BY 1"""


# --- single rules ------------------------------------------------------------------------


def unique_filenames(spark, sf):
    requests = view(spark, sf, "filename_requests").withColumn("stem", names.file_stem(names.kept_characters(F.col("part_name"))))
    existing = requests.select(
        F.explode(F.array(*[F.concat("stem", F.lit(s)) for s in _TAKEN_SUFFIXES])).alias("name")
    ).distinct()
    return naming.allocate_names(requests, existing, "delivery_id").select(
        "delivery_id", "stem", F.col("slot").cast("bigint").alias("slot"), "target_name"
    )


FILENAMES_SQL = with_views(
    "filename_requests",
    **_sql_allocated(
        f"SELECT delivery_id, {_sql_clean('part_name')} AS stem FROM filename_requests",
        "SELECT DISTINCT stem || s AS name FROM requests, (VALUES (''), ('-2'), ('-5')) AS t(s)",
    ),
) + """
SELECT delivery_id, stem, CAST(slot AS BIGINT) AS slot, target_name FROM allocated"""


def label_map(spark, sf):
    documents = spread(table(spark, sf, "documents"), "doc_id").select(
        "doc_id",
        F.col("doc_id").alias("deliverable_asset"),
        F.when(F.col("doc_id") % 3 > 0, F.col("doc_id") * 2).alias("deliverable_bundle"),
        F.col("text").alias("online_id"),
        F.col("source").alias("nearline_id"),
        F.when(F.col("doc_id") % 2 > 0, F.col("lang")).alias("archive_id"),
    )
    own = launch.label_map(launch.request_labels())
    base = F.create_map(*[F.lit(x) for pair in BASE_LABELS.items() for x in pair])
    labelled = evaluate_once(documents, "labels", launch.merge_labels(base, own))
    return labelled.select(
        "doc_id",
        F.size("labels").cast("bigint").alias("label_count"),
        *[F.col("labels")[k].alias(k.replace("-", "_")) for k in ("app", *fixed.LABELS)],
    )


LABEL_SQL = f"""
SELECT doc_id, CAST(6 AS BIGINT) AS label_count, 'delivery' AS app, CAST(doc_id AS VARCHAR) AS deliverable_asset_id,
    CASE WHEN doc_id % 3 > 0 THEN CAST(doc_id * 2 AS VARCHAR) ELSE 'None' END AS deliverable_bundle_id,
    {_sql_label('text')} AS online_id, {_sql_label('source')} AS nearline_id,
    CASE WHEN doc_id % 2 > 0 THEN {_sql_label('lang')} ELSE 'None' END AS archive_id
FROM documents"""


def job_names(spark, sf):
    documents = spread(table(spark, sf, "documents").select("doc_id", "source", "text"), "doc_id")
    suffix = names.token(fixed.JOB_TOKEN_LENGTH, names.digest(F.col("doc_id"), F.col("source")))
    kept = evaluate_once(documents, "kept", names.kept_characters(F.col("text")))
    source = names.kept_characters(F.col("source"))
    return kept.select(
        "doc_id",
        names.trim_name(F.col("kept")).alias("clean_name"),
        names.job_name(F.col("kept"), suffix).alias("job_name"),
        names.job_name(source, suffix, keep_suffix=False).alias("short_name"),
    )


_DOC_SUFFIX = _sql_token("sha256(CAST(doc_id AS VARCHAR) || '|' || source)", 4)
_LONG = "'cds-' || text || '-' || suffix"
NAMES_SQL = f"""
SELECT doc_id, {_sql_clean('text')} AS clean_name,
    CASE WHEN length({_sql_clean(_LONG, 1 << 20)}) <= 59 THEN {_sql_clean(_LONG)}
        ELSE {_sql_clean(chr(39) + 'cds-' + chr(39) + ' || text', 54)} || '-' || suffix END AS job_name,
    {_sql_clean("'cds-' || source || '-' || suffix")} AS short_name
FROM (SELECT *, {_DOC_SUFFIX} AS suffix FROM documents)"""


def filename_hints(spark, sf):
    checked = mq.validate(uploads(spark, sf), fixed.UPLOAD_SCHEMA).where(F.col("disposition") == mq.ACK)
    hint = names.name_hint(F.lit("(token)"), *[F.col(c) for c in fixed.HINT_FIELDS])
    return checked.select("delivery_id", hint.alias("hint"))


HINTS_SQL = f"""
SELECT d AS delivery_id, coalesce({_FILENAME}, {_ONLINE}, {_NEARLINE}, {_ARCHIVE}, '(token)') AS hint
FROM (SELECT o_orderkey AS d, o_custkey AS c FROM orders) WHERE d % 19 <> 0 AND d % 13 <> 0 AND d % 17 <> 0"""

QUERIES = {
    "launch_plan": (launch_plan, LAUNCH_SQL),
    "repeated_job_names": (repeated_job_names, REPEATED_SQL),
    "launch_documents": (launch_documents, DOCUMENTS_SQL),
    "launch_outcomes": (launch_outcomes, OUTCOMES_SQL),
    "outcome_union": (outcome_union, UNION_SQL),
    "metadata_files": (metadata_files, FILES_SQL),
    "unique_filenames": (unique_filenames, FILENAMES_SQL),
    "label_map": (label_map, LABEL_SQL),
    "job_names": (job_names, NAMES_SQL),
    "filename_hints": (filename_hints, HINTS_SQL),
}
