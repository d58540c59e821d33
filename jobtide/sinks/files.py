"""File sinks.  Every writer takes its folder as an argument."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from jobtide import fixed
from jobtide.functions.text import iso_offset
from jobtide.operators.messages import ACK, DEAD_LETTER, check_size
from jobtide.session import written
from jobtide.sources.ranges import partition_folder, publish_drafts, write_drafts, write_files


def _replacing(df: DataFrame, *folders: str):
    """Writer that replaces the folders it has rows for and leaves all others alone."""
    return df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*folders)


def publish(messages: DataFrame, path: str, run: str, max_bytes: int | None = None) -> None:
    """JSON bodies as lines, one folder per run and routing key; a run that is repeated replaces its own.

    Bodies beyond ``max_bytes`` go to ``{path}-rejected`` instead, with the reason.
    """
    marked = messages.withColumn("run", F.lit(run))
    if max_bytes is not None:
        checked = check_size(marked, max_bytes)
        rejected = checked.where(F.col("disposition") == DEAD_LETTER)
        _replacing(rejected.select("run", "routing_key", "body", "reason"), "run").parquet(f"{path}-rejected")
        marked = checked.where(F.col("disposition") == ACK)
    _replacing(marked.select("run", "routing_key", "body"), "run", "routing_key").text(path)


def start(writer: DataStreamWriter, checkpoint: str, trigger: Mapping[str, object] | None = None) -> StreamingQuery:
    """Start a stream.  ``trigger`` is Spark's, such as ``{"processingTime": "5 seconds"}``.

    Without one the stream takes what is there and stops.
    """
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def publish_stream(
    messages: DataFrame,
    checkpoint: str,
    path: str | None = None,
    trigger: Mapping[str, object] | None = None,
    **kafka: str,
) -> StreamingQuery:
    """Publish a stream to files, or to Kafka when its options are given.

    The position of the stream is recorded after the micro-batch has been written.
    """
    if kafka:
        writer = (
            messages.select(F.col("routing_key").alias("key"), F.col("body").alias("value"))
            .writeStream.format("kafka")
            .options(**kafka)
        )
    else:
        writer = (
            messages.select("routing_key", "body")
            .writeStream.format("text")
            .partitionBy("routing_key")
            .option("path", path)
        )
    return start(writer, checkpoint, trigger)


def write_metadata(plan: DataFrame, path: str, run: str) -> None:
    """Metadata documents under their target names, one folder per run and route.

    A run that is repeated replaces what it wrote before.
    """
    documents = plan.select(F.lit(run).alias("run"), "metadata_path", F.col("inmeta").alias("content"), "routename")
    _replacing(documents, "run", "routename").parquet(path)


def write_pod_logs(lines: DataFrame, base: str | None) -> bool:
    """Archive pod logs below ``base``, one folder per job and pod; nothing without a base.

    A log that is archived again is replaced, as a file of that name would be.
    Rows are laid out by job, pod and line number in ranges of similar size: a small log is
    one file, a log of very many lines spans several files whose order is the line order.

    Tasks write the files as drafts; once all are there, tasks put them in the place of those that a log had.  The
    driver does nothing per pod.
    """
    if base is None:
        return False
    ordered = (
        lines.select("job_name", "pod_name", "line_no", "line")
        .repartitionByRange("job_name", "pod_name", "line_no")
        .sortWithinPartitions("job_name", "pod_name", "line_no")
    )
    # null names and lines stay apart from empty ones as Spark's writer has it: one folder for both, an empty line for both
    folder = F.concat_ws("/", F.lit(base.rstrip("/")), partition_folder("job_name"), partition_folder("pod_name"))
    drafts = write_drafts(ordered.select(folder.alias("folder"), F.coalesce("line", F.lit("")).alias("line")), uuid.uuid4().hex)
    publish_drafts(written(drafts, "drafts").groupBy("folder").agg(F.collect_set("name").alias("names")))
    return True


def write_listing(files: DataFrame, path: str, mode: str = "append") -> None:
    """Log listing as one JSON object per line, times with zone."""
    files.select(
        F.col("log").alias("name"),
        "size",
        iso_offset(F.col("last_modified"), with_zone=True).alias("lastModified"),
    ).write.mode(mode).json(path)


def write_pointers(pointers: DataFrame, base: str) -> int:
    """One text file per job with the path of its log (``job_name``, ``log_path``); returns how many.

    Tasks write the files, each under its final name; the driver does nothing per job.  Of several rows of a job the
    greatest path counts, whatever task it is in.  A pointer that is written again is replaced.
    """
    target = f"{base.rstrip('/')}/{fixed.POINTER_DIR}/"
    one = pointers.where("job_name is not null").groupBy("job_name").agg(F.max("log_path").alias("log_path"))
    path = F.concat(F.lit(target), F.url_encode("job_name"), F.lit(fixed.POINTER_SUFFIX))
    # a file's content ends its only line
    return write_files(one.select(path.alias("path"), F.concat(F.coalesce("log_path", F.lit("")), F.lit("\n")).alias("content")))


# --- states and positions: small appended tables, the newest entry counts --------------

_STATE = "uid STRING, resource_version BIGINT, name STRING, status STRING, deleted BOOLEAN"


def append_states(states: DataFrame, root: str, run: str, batch_id: int) -> None:
    """Changed job states of one batch of one run; writing a batch again replaces it.

    ``states`` has uid, resource_version, name, status and deleted.  ``run`` is the id of the stream's
    checkpoint, so a stream that starts anew never replaces what an earlier one has left.
    """
    kept = states.select("uid", "resource_version", "name", "status", "deleted")
    kept.write.mode("overwrite").parquet(f"{root}/run={run}/batch={batch_id}")


def _newest_states(spark: SparkSession, root: str) -> DataFrame:
    entry = F.struct("resource_version", "deleted", "name", "status")
    return (
        spark.read.option("recursiveFileLookup", True)
        .schema(_STATE)
        .parquet(root)
        .groupBy("uid")
        .agg(F.max(entry).alias("newest"))
        .select("uid", "newest.*")
    )


def read_states(spark: SparkSession, root: str) -> DataFrame:
    """Newest state of each job that is not deleted.

    Only the newest version counts, whichever batch brought it, so a batch that is written
    twice changes nothing.
    """
    return _newest_states(spark, root).where(~F.col("deleted")).drop("deleted")


def compact_states(spark: SparkSession, root: str, target: str) -> None:
    """Write the newest entry of each job, deletions included, as the start of a new table.

    A deletion has to stay: an older change that arrives late would bring the job back.
    """
    append_states(_newest_states(spark, root), target, "compacted", 0)


def record_position(spark: SparkSession, root: str, sequence: int, position: int | None) -> None:
    """Journal entry; without a position it clears the journal."""
    row = [(sequence, None if position is None else str(position))]
    spark.createDataFrame(row, "sequence BIGINT, position_text STRING").coalesce(1).write.mode(
        "overwrite"
    ).parquet(f"{root}/entry={sequence}")


def last_position(spark: SparkSession, root: str) -> DataFrame:
    """The newest journal entry (one row; NULL position means: start from now)."""
    from jobtide.operators.jobs import read_positions

    entries = (
        spark.read.option("recursiveFileLookup", True)
        .schema("sequence BIGINT, position_text STRING")
        .parquet(root)
    )
    newest = entries.agg(F.max_by("position_text", "sequence").alias("position_text"))
    return read_positions(newest).select("position")


def recover_position(spark: SparkSession, root: str, events: DataFrame, sequence: int) -> int | None:
    """Where to go on after the newest journal entry, given the events that are still kept.

    A position whose next events are gone cannot be resumed: the journal is cleared by the entry
    ``sequence`` and work goes on at the newest event, as it does without any position.
    """
    position = last_position(spark, root).first()["position"]
    kept = events.agg(F.min("resource_version").alias("oldest"), F.max("resource_version").alias("newest")).first()
    if position is not None and (kept["oldest"] is None or position >= kept["oldest"] - 1):
        return position
    if position is not None:
        record_position(spark, root, sequence, None)
    return kept["newest"]
