"""Keyed state of streams in tables that are merged in levels: last states of jobs, with look-up."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.streaming import StreamingQuery

from jobtide.operators.jobs import classify_jobs
from jobtide.sinks.files import start
from jobtide.sinks.merged import MergedTable
from jobtide.streaming.runner import batch_folder, run_id

LOOKED_UP = "looked_up"
_ENTRY = "STRUCT<resource_version: BIGINT, deleted: BOOLEAN, name: STRING, status: STRING>"


def state_table(spark: SparkSession, root: str, **sizes: int) -> MergedTable:
    """The newest state of each job; deletions stay as entries, so an older change that arrives late brings nothing back."""
    return MergedTable(spark, f"{root}/states", ["uid"], {"newest": (_ENTRY, "max")}, **sizes)


def state_changes(events: DataFrame) -> DataFrame:
    """uid and entry (version, deleted, name, status) of each event that changes a job's state."""
    live = classify_jobs(events).select("uid", "resource_version", F.lit(False).alias("deleted"), "name", "status")
    gone = events.where((F.col("object_kind") == "Job") & (F.col("watch_type") == "DELETED")).select(
        "uid", "resource_version", F.lit(True).alias("deleted"), "name", F.lit(None).cast("string").alias("status")
    )
    return live.unionByName(gone)


def lookup_batch(batch: DataFrame, batch_id: int, root: str, run: str = "0", **sizes: int) -> None:
    """Write each change of a micro-batch next to the state before it, then add the batch to the table of states.

    The state before is the change of the job with the next smaller version in the same batch, or else what
    the table held before the batch; NULL if the job is new or was deleted last.
    """
    table = state_table(batch.sparkSession, root, **sizes)
    changes = state_changes(batch).persist()
    try:
        known = table.lookup(changes.select("uid"), run, batch_id).select("uid", "newest.*").withColumn("__new", F.lit(False))
        # a state of the table counts before the batch, whatever its version
        rows = changes.withColumn("__new", F.lit(True)).unionByName(known)
        order = W.partitionBy("uid").orderBy("__new", "resource_version")
        before = F.lag(F.struct("status", "deleted")).over(order)
        looked = rows.withColumn("__before", before).where("__new")
        looked = looked.select(
            "resource_version", "uid", "name", "status", "deleted",
            F.when(~F.col("__before.deleted"), F.col("__before.status")).alias("last_status"),
        )
        looked.write.mode("overwrite").parquet(batch_folder(root, LOOKED_UP, run, batch_id))
        entry = F.struct("resource_version", "deleted", "name", "status")
        table.write(changes.select("uid", entry.alias("newest")), run, batch_id)
    finally:
        changes.unpersist()


def run_lookup_stream(
    events: DataFrame, checkpoint: str, root: str, trigger: Mapping[str, object] | None = None, **sizes: int
) -> StreamingQuery:
    """Give each change the last recorded state of its job, and keep these states.

    A batch reads the runs and buckets that hold its own jobs; that does not grow with the number of batches.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        lookup_batch(batch, batch_id, root, run_id(batch.sparkSession, checkpoint), **sizes)

    return start(events.writeStream.foreachBatch(apply), checkpoint, trigger)


def read_last_states(spark: SparkSession, root: str, **sizes: int) -> DataFrame:
    """Newest state of each job that is not deleted."""
    newest = state_table(spark, root, **sizes).read().select("uid", "newest.*")
    return newest.where(~F.col("deleted")).select("uid", "resource_version", "name", "status")
