"""Launch planning: from valid upload requests to job documents and outcome messages."""

from __future__ import annotations

import copy
import json
from collections.abc import Callable, Collection, Mapping

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from jobtide import fixed
from jobtide.functions import names
from jobtide.operators.messages import ACK, DEAD_LETTER, TEXT_OF
from jobtide.operators.metadata import SCHEMA_FILE, parse_metadata
from jobtide.operators.naming import allocate_names
from jobtide.operators.numbering import DEFAULT_SLICE
from jobtide.operators.once import evaluate_once
from jobtide.session import written

_DELIVERY = ("exchange", "routing_key", "body", "delivery_id")


def filename_hint(digest: Column) -> Column:
    fallback = names.token(fixed.HINT_TOKEN_LENGTH, digest)
    return names.name_hint(fallback, *[F.col(c) for c in fixed.HINT_FIELDS])


def request_labels(columns: Collection[str] = ()) -> dict[str, Column]:
    """The request's own labels; a missing value becomes the text for 'no value'.

    Of an integer the label is its text where ``columns`` has that, so no digit is lost.
    """
    out = {}
    for label, field in fixed.LABELS.items():
        known = TEXT_OF.format(field) if TEXT_OF.format(field) in columns else field
        text = F.coalesce(F.col(known).cast("string"), F.lit(fixed.NO_STATUS_TEXT))
        out[label] = text if label in fixed.NUMERIC_LABELS else names.safe_label(text)
    return out


def merge_labels(base: Column, own: Column) -> Column:
    """Template labels overlaid by the request's labels."""
    kept = F.map_filter(base, lambda k, _: ~F.array_contains(F.map_keys(own), k))
    return F.map_concat(kept, own)


def label_map(labels: Mapping[str, Column], base: Mapping[str, str] | None = None) -> Column:
    """One map column; on equal names the request's label wins."""
    merged = {k: F.lit(v) for k, v in (base or {}).items()} | dict(labels)
    return F.create_map(*[c for k, v in merged.items() for c in (F.lit(k), v)])


def launch_command(metadata_path: Column, route: Column) -> Column:
    return F.array(
        F.lit(fixed.LAUNCH_PROGRAM),
        F.lit(fixed.LAUNCH_METADATA_FLAG),
        metadata_path,
        F.lit(fixed.LAUNCH_ROUTE_FLAG),
        route,
    )


def check_metadata(requests: DataFrame, xsd=SCHEMA_FILE) -> DataFrame:
    """Reject requests whose metadata is not valid; their outcome message says so.

    Requests rejected before are passed on as they are, and their metadata is not parsed.
    """
    fit = F.col("disposition") == ACK
    parsed = parse_metadata(requests.withColumn("__xml_text", F.when(fit, F.col("inmeta"))), "__xml_text", xsd)
    bad = fit & ~F.col("metadata_valid")
    error = F.lit("metadata is not valid")
    return parsed.withColumns(
        {
            "disposition": F.when(bad, DEAD_LETTER).otherwise(F.col("disposition")),
            "reason": F.when(bad, "xml").otherwise(F.col("reason")),
            "outcome_key": F.when(bad, fixed.STATUS_KEY_PREFIX + fixed.INVALID),
            "outcome_body": F.when(bad, outcome_body(F.col("body"), {"error": error})),
        }
    ).drop("__xml_text")


def outcome_body(body: Column, extra: Mapping[str, Column]) -> Column:
    """The original JSON object with further text fields at its end; NULL fields stay out."""
    added = F.to_json(F.struct(*[v.alias(k) for k, v in extra.items()]))
    head = F.regexp_replace(F.trim(body.cast("string")), r"\s*\}\s*$", "")
    tail = F.substr(added, F.lit(2))
    return F.when(added == "{}", body.cast("string")).otherwise(
        F.concat(head, F.when(head == "{", "").otherwise(","), tail)
    )


def plan_launches(
    requests: DataFrame,
    existing: DataFrame,
    base_path: str,
    namespace: str,
    base_labels: Mapping[str, str] | None = None,
    slice_width: int = DEFAULT_SLICE,
    given_slots: Callable[[DataFrame], DataFrame] | None = None,
    given_jobs: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Job name, metadata path, command and labels of each valid request.

    ``existing`` has the target names in use (``name``).  What earlier plans have given out is looked up by
    key: ``given_slots`` returns the bitmaps (``naming.SLOT_WORDS``) of the stems (``stem``) it gets, ``given_jobs`` how often
    (``given``) the job names it gets (``job_head``, ``job_suffix``) are in use.  Target names and job names are unique,
    also against those.  Requests with a blank stem or without a free target name stay in the
    result as dead letters with a reason and an ``invalid`` outcome.

    Names are dealt out on a narrow table (one row per delivery, no payload), written while the plan is
    built; its names are then joined to the requests, of which a caller reads the columns it needs.
    """
    delivery = [F.col(c) for c in _DELIVERY]
    marked = evaluate_once(requests, "__digest", names.digest(*delivery))
    hinted = marked.withColumn("hint", filename_hint(F.col("__digest")))
    prepared = evaluate_once(hinted, "__kept", names.kept_characters(F.col("hint")))
    suffix = names.token(fixed.JOB_TOKEN_LENGTH, F.col("__digest"))
    narrow = prepared.select(
        "__digest",
        "delivery_id",
        names.file_stem(F.col("__kept")).alias("stem"),
        names.short_head(F.col("__kept")).alias("job_head"),
        suffix.alias("job_suffix"),
    ).distinct()
    # dealing out reads these few columns several times; bodies and metadata are not among them
    narrow = written(narrow, "launch-names")
    slots = given_slots(narrow.select("stem")) if given_slots else None
    named = allocate_names(narrow, existing, "delivery_id", slice_width=slice_width, tie="__digest", given=slots)
    head = ["job_head", "job_suffix"]
    # the suffix comes from a digest, so no head and suffix has more than a few rows
    number = F.row_number().over(W.partitionBy(*head).orderBy("delivery_id", "__digest"))
    named = named.withColumn("__number", number)
    if given_jobs is not None:
        given = given_jobs(narrow.select(*head)).select(*head, F.col("given").alias("__given"))
        named = named.join(given, head, "left")
        named = named.withColumn("__number", F.col("__number") + F.coalesce("__given", F.lit(0))).drop("__given")
    # parsed bodies count 2 kB a row until they are dropped, by which the optimizer takes what is left for a twentieth of
    # its size: without the hint the driver would gather all requests for a broadcast
    joined = prepared.hint("merge").join(named.drop("delivery_id"), "__digest")
    reason = F.when(F.col("stem") == "", "blank_name").when(F.col("target_name").isNull(), "no_free_name")
    path = F.concat(
        F.lit(base_path.rstrip("/") + "/"), F.col("target_name"), F.lit(fixed.METADATA_SUFFIX)
    )
    planned = joined.withColumn("reason", reason).withColumns(
        {
            "job_name": names.numbered_job_name(F.col("__kept"), F.col("job_suffix"), F.col("__number")),
            "labels": label_map(request_labels(requests.columns), base_labels),
            "disposition": F.when(F.col("reason").isNull(), ACK).otherwise(DEAD_LETTER),
            "job_namespace": F.lit(namespace),
            "metadata_path": F.when(F.col("reason").isNull(), path),
        }
    )
    ok = F.col("reason").isNull()
    return planned.withColumns(
        {
            "command": F.when(ok, launch_command(F.col("metadata_path"), F.col("routename"))),
            "status": F.when(ok, fixed.STARTED).otherwise(fixed.INVALID),
            "error": F.when(~ok, F.concat(F.lit("cannot launch: "), F.col("reason"))),
        }
    ).drop("__digest", "__kept", "__number")


# strings no template holds; they stand where the plan's values go
_NAME, _LABEL, _COMMAND = "\x01name\x01", "\x01labels\x01", "\x01command\x01"


def job_document(template: Mapping | None = None) -> Column:
    """Job manifest as JSON: the whole template, overlaid by name, labels and command of the plan.

    Everything else in the template stays as it is: environment, volumes, annotations, further
    containers, and its own labels where the plan has none of that name (``labels`` of the plan win).
    The command goes to the first container.
    """
    document = copy.deepcopy(dict(template or {}))
    document.setdefault("apiVersion", "batch/v1")
    document["kind"] = "Job"
    metadata = document.setdefault("metadata", {})
    own_labels = metadata.get("labels") or {}
    metadata["name"], metadata["labels"] = _NAME, _LABEL
    inner = document.setdefault("spec", {}).setdefault("template", {}).setdefault("spec", {})
    containers = inner.setdefault("containers", [])
    if not containers:
        containers.append({})
    containers[0]["command"] = _COMMAND
    base = F.create_map(*[F.lit(str(x)) for pair in own_labels.items() for x in pair]) if own_labels else None
    labels = merge_labels(base, F.col("labels")) if own_labels else F.col("labels")
    # a job name needs no escapes
    name = F.concat(F.lit('"'), F.col("job_name"), F.lit('"'))
    values = {_NAME: name, _LABEL: F.to_json(labels), _COMMAND: F.to_json("command")}
    parts, rest = [], json.dumps(document, separators=(",", ":"), ensure_ascii=False)
    while rest:
        places = {rest.find(json.dumps(mark)): mark for mark in values if json.dumps(mark) in rest}
        if not places:
            parts.append(F.lit(rest))
            break
        at = min(places)
        parts += [F.lit(rest[:at]), values[places[at]]]
        rest = rest[at + len(json.dumps(places[at])) :]
    return F.concat(*parts)


def launch_outcomes(plan: DataFrame) -> DataFrame:
    """Outcome message per request: started with the job's ids, or invalid with the error."""
    ok = F.col("status") == fixed.STARTED
    ids = {
        "job-id": F.when(ok, F.col("job_id")) if "job_id" in plan.columns else F.lit(None).cast("string"),
        "job-name": F.col("job_name"),
        "job-namespace": F.when(ok, F.col("job_namespace")),
        "error": F.col("error"),
    }
    return plan.withColumns(
        {
            "outcome_key": F.concat(F.lit(fixed.STATUS_KEY_PREFIX), F.col("status")),
            "outcome_body": outcome_body(F.col("body"), ids),
        }
    )
