"""Upload requests to launches, and status messages to archives, as streams.

Each micro-batch writes tables below a root folder, every one under the run (the checkpoint's
id) and the batch, so a batch that is repeated replaces its own results and nothing else.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from jobtide import fixed
from jobtide.operators import launch, reaping
from jobtide.operators.messages import ACK, DEAD_LETTER, Handler, fits, unrouted, validate
from jobtide.operators.naming import SLOT_WORDS, slot_words
from jobtide.session import held
from jobtide.sinks.files import start, write_metadata, write_pod_logs
from jobtide.sinks.merged import MergedTable
from jobtide.streaming.runner import DEAD_LETTERS, OUTCOMES, UNROUTED, VERDICTS, batch_folder, dealt_out, run_id

PLANS, NAMES, METADATA, ACTIONS = "plans", "names", "metadata", "actions"
HELD = "held"  # tables of the batch that is running


def slot_table(spark: SparkSession, root: str, **sizes: int) -> MergedTable:
    """Taken slots of each stem as one bitmap, for all names that were ever given out below a root."""
    return MergedTable(spark, f"{root}/slots", ["stem"], {c: ("BIGINT", "bit_or") for c in SLOT_WORDS}, **sizes)


def job_table(spark: SparkSession, root: str, **sizes: int) -> MergedTable:
    """How many jobs were given each head and suffix."""
    return MergedTable(spark, f"{root}/jobs", ["job_head", "job_suffix"], {"given": ("BIGINT", "sum")}, **sizes)


def launch_batch(
    batch: DataFrame,
    batch_id: int,
    handler: Handler,
    root: str,
    base_path: str,
    namespace: str,
    run: str = "0",
    existing: DataFrame | None = None,
    base_labels: Mapping[str, str] | None = None,
    template: Mapping | None = None,
) -> None:
    """Check the requests of one micro-batch, plan their launches, write all results.

    Names are carried from batch to batch in two keyed tables, so no two launches ever share a job
    name or a metadata file.  A batch reads one row for each of its own stems and job names, from the buckets
    that hold these, however many names were given before.  The verdicts hold every message of the batch once.
    Checked and planned requests are read for each result; they lie below the root until the batch is done, not in memory.
    """
    spark = batch.sparkSession
    batch = dealt_out(batch)
    routed = batch.where(fits(handler.binding)).withColumn("handler", F.lit(handler.name))
    checked = launch.check_metadata(validate(routed, handler.schema)).drop("metadata_pairs", "metadata_type", "movie_tokens")
    with held(checked, batch_folder(root, f"{HELD}/checked", run, batch_id)) as checked:
        slots, jobs = slot_table(spark, root), job_table(spark, root)
        taken = spark.createDataFrame([], "name STRING") if existing is None else existing.select("name")
        valid = checked.where(F.col("disposition") == ACK).drop("disposition", "reason", "outcome_key", "outcome_body")
        planned = launch.plan_launches(
            valid,
            taken,
            base_path,
            namespace,
            base_labels,
            given_slots=lambda stems: slots.lookup(stems, run, batch_id),
            given_jobs=lambda names: jobs.lookup(names, run, batch_id),
        )
        planned = launch.launch_outcomes(planned).withColumn("document", launch.job_document(template))
        with held(planned, batch_folder(root, f"{HELD}/planned", run, batch_id)) as planned:
            _write_launches(batch, batch_id, handler, root, run, checked, planned)
            started = planned.where(F.col("status") == fixed.STARTED)
            slots.write(slot_words(started.select(F.col("target_name").alias("name"))), run, batch_id)
            jobs.write(started.select("job_head", "job_suffix", F.lit(1).cast("bigint").alias("given")), run, batch_id)


def _write_launches(batch, batch_id, handler, root, run, checked, planned) -> None:
    def write(rows: DataFrame, folder: str) -> None:
        rows.write.mode("overwrite").parquet(batch_folder(root, folder, run, batch_id))

    original = batch.columns
    started = planned.where(F.col("status") == fixed.STARTED)
    rejected = checked.where(F.col("disposition") != ACK)
    lost = unrouted(batch, [handler.binding])
    write(started.select(F.col("target_name").alias("name"), "job_head", "job_suffix"), NAMES)
    write(started.select("delivery_id", "job_name", "job_namespace", "metadata_path", "document"), PLANS)
    write_metadata(started, f"{root}/{METADATA}", f"{run}-{batch_id}")
    outcome = ("delivery_id", F.col("outcome_key").alias("routing_key"), F.col("outcome_body").alias("body"))
    invalid = rejected.where(F.col("outcome_key").isNotNull())
    write(planned.select(*outcome).unionByName(invalid.select(*outcome)), OUTCOMES)
    verdict = ("delivery_id", "attempt", "handler", "disposition", "reason")
    nobody = lost.select("delivery_id", "attempt", F.lit(None).cast("string").alias("handler"), F.lit("unrouted").alias("disposition"), F.lit("no_binding").alias("reason"))
    write(planned.select(*verdict).unionByName(rejected.select(*verdict)).unionByName(nobody), VERDICTS)
    dead = [df.where(F.col("disposition") == DEAD_LETTER).select(*original, "handler", "reason") for df in (planned, rejected)]
    write(dead[0].unionByName(dead[1]), DEAD_LETTERS)
    write(lost, UNROUTED)


def run_launch_stream(
    messages: DataFrame,
    handler: Handler,
    checkpoint: str,
    root: str,
    base_path: str,
    namespace: str,
    existing: DataFrame | None = None,
    base_labels: Mapping[str, str] | None = None,
    template: Mapping | None = None,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Validate, write metadata, plan the launch and announce it, for every upload request that arrives."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        run = run_id(batch.sparkSession, checkpoint)
        launch_batch(batch, batch_id, handler, root, base_path, namespace, run, existing, base_labels, template)

    return start(messages.writeStream.foreachBatch(apply), checkpoint, trigger)


def reap_batch(
    batch: DataFrame,
    batch_id: int,
    handler: Handler,
    root: str,
    pods: Callable[[], DataFrame],
    lines: Callable[[], DataFrame],
    archive: str | None,
    keep: bool = False,
    run: str = "0",
) -> None:
    """Archive the pod logs of the jobs that have ended and say which jobs to delete.

    ``pods`` and ``lines`` give the tables as they are when the batch runs.  A log that is archived
    again replaces the one before.
    """
    routed = dealt_out(batch).where(fits(handler.binding)).withColumn("handler", F.lit(handler.name))
    checked = validate(routed, handler.schema).persist()
    try:
        plan = reaping.plan_reaping(checked.where(F.col("disposition") == ACK), F.lit(keep))
        actions = plan.select("delivery_id", "job_id", "job_name", "job_namespace", "action")
        actions.write.mode("overwrite").parquet(batch_folder(root, ACTIONS, run, batch_id))
        rejected = checked.where(F.col("disposition") != ACK).select(*batch.columns, "handler", "reason")
        rejected.write.mode("overwrite").parquet(batch_folder(root, DEAD_LETTERS, run, batch_id))
        write_pod_logs(reaping.archive_lines(plan, pods(), lines()), archive)
    finally:
        checked.unpersist()


def run_reap_stream(
    messages: DataFrame,
    handler: Handler,
    checkpoint: str,
    root: str,
    pods: Callable[[], DataFrame],
    lines: Callable[[], DataFrame],
    archive: str | None,
    keep: bool = False,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Reap on every status message of a job that has ended."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        reap_batch(batch, batch_id, handler, root, pods, lines, archive, keep, run_id(batch.sparkSession, checkpoint))

    return start(messages.writeStream.foreachBatch(apply), checkpoint, trigger)
