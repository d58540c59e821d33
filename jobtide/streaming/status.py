"""Status messages and latest states from a stream of change events."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from jobtide.operators.jobs import classify_jobs, latest_state, status_messages
from jobtide.sinks.files import append_states, publish_stream, start
from jobtide.sources.events import stream_deduplicated
from jobtide.streaming.runner import run_id

Trigger = Mapping[str, object] | None


def run_status_stream(
    events: DataFrame, checkpoint: str, path: str, trigger: Trigger = None, deduplicate: str | None = "1 hour"
) -> StreamingQuery:
    """Publish one status message per watched event; the checkpoint is the journal.

    A change that is delivered again within ``deduplicate`` is published once.
    """
    once = stream_deduplicated(events, deduplicate) if deduplicate else events
    return publish_stream(status_messages(classify_jobs(once)), checkpoint, path, trigger)


def run_state_stream(events: DataFrame, checkpoint: str, root: str, trigger: Trigger = None) -> StreamingQuery:
    """Keep the latest state of each job; a deleted job is marked, not forgotten.

    Each micro-batch is reduced to one row per job before it is written, so the table grows
    with changed jobs, not with events.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        live = classify_jobs(batch).select(
            "uid", "resource_version", "name", "status", F.lit(False).alias("deleted")
        )
        gone = batch.where((F.col("object_kind") == "Job") & (F.col("watch_type") == "DELETED")).select(
            "uid", "resource_version", "name", F.lit(None).cast("string").alias("status"), F.lit(True).alias("deleted")
        )
        append_states(latest_state(live.unionByName(gone)), root, run_id(batch.sparkSession, checkpoint), batch_id)

    return start(events.writeStream.foreachBatch(apply), checkpoint, trigger)
