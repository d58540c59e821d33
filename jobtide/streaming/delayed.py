"""Messages that come back when they are due.

A message that is put back waits ``delay * attempt`` seconds.  It lies in a queue whose folders are named by
the time it is due, rounded up to ``SLOT`` seconds.  A release moves what has become due since the release before
into the folder from which the message stream reads; it looks at no other folder.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from jobtide import fixed
from jobtide.operators.messages import MESSAGE_SCHEMA, Handler
from jobtide.sinks.files import start
from jobtide.streaming.runner import RETRY, batch_folder, run_id, write_batch

DELAYED, RELEASES = "delayed", "releases"
SLOT = 5  # seconds


def due_slot(now: int, attempt_column: str = "attempt", delay: int = fixed.PUBLISH_DELAY_SECONDS, slot: int = SLOT):
    """The slot in which a message that failed at ``now`` comes back; never before its time."""
    # the attempt that is put back counts one more than the one that failed
    due = F.lit(now) + (F.col(attempt_column) - 1) * delay
    return (F.ceil(due / slot) * slot).cast("bigint")


def delay_batch(spark: SparkSession, root: str, run: str, batch_id: int, now: int, delay: int, slot: int) -> None:
    """Put the messages that a batch wants back into the queue."""
    again = spark.read.schema(MESSAGE_SCHEMA).parquet(batch_folder(root, RETRY, run, batch_id))
    placed = again.withColumns({"due": due_slot(now, delay=delay, slot=slot), "run": F.lit(run), "batch": F.lit(batch_id)})
    writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("due", "run", "batch").parquet(f"{root}/{DELAYED}")


def release_due(spark: SparkSession, root: str, after: int, until: int) -> None:
    """Hand over the messages that became due after ``after`` and up to ``until``; doing it again changes nothing."""
    shape = ", ".join([*[f"`{field.name}` {field.dataType.simpleString()}" for field in MESSAGE_SCHEMA], "due BIGINT", "run STRING", "batch BIGINT"])
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/{DELAYED}")
    if not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        return  # nothing was ever put back
    waiting = spark.read.schema(shape).parquet(f"{root}/{DELAYED}").where((F.col("due") > after) & (F.col("due") <= until))
    waiting.drop("due", "run", "batch").write.mode("overwrite").parquet(f"{root}/{RELEASES}/until={until}")


def run_delayed_stream(
    messages: DataFrame,
    handlers: Sequence[Handler],
    checkpoint: str,
    root: str,
    now: int,
    max_attempts: int | None = fixed.MAX_ATTEMPTS,
    delay: int = fixed.PUBLISH_DELAY_SECONDS,
    slot: int = SLOT,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Process what has arrived at ``now`` (seconds); what is put back waits in the queue.

    Include ``{root}/releases`` among the folders of ``messages`` and call ``release_due`` before each run.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark, run = batch.sparkSession, run_id(batch.sparkSession, checkpoint)
        write_batch(batch, batch_id, handlers, root, max_attempts, run)
        delay_batch(spark, root, run, batch_id, now, delay, slot)

    return start(messages.writeStream.foreachBatch(apply), checkpoint, trigger)
