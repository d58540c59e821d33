"""Message processing as a stream: handlers, outcomes, retries, dead letters."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from jobtide.operators.messages import ACK, DEAD_LETTER, REQUEUE, Handler, process
from jobtide.sinks.files import start

VERDICTS, OUTCOMES, DEAD_LETTERS, RETRY, UNROUTED = (
    "verdicts",
    "outcomes",
    "dead_letters",
    "retry",
    "unrouted",
)


def limit_attempts(processed: DataFrame, max_attempts: int | None) -> DataFrame:
    """Turn a requeue after the last permitted attempt into a dead letter."""
    if max_attempts is None:
        return processed
    spent = (F.col("disposition") == REQUEUE) & (F.coalesce("attempt", F.lit(1)) >= max_attempts)
    return processed.withColumns(
        {
            "reason": F.when(spent, "attempts_exhausted").otherwise(F.col("reason")),
            "disposition": F.when(spent, DEAD_LETTER).otherwise(F.col("disposition")),
        }
    )


def run_id(spark: SparkSession, checkpoint: str) -> str:
    """Id of the stream that owns a checkpoint: the same after a restart, another one for a new checkpoint."""
    return spark.read.json(f"{checkpoint.rstrip('/')}/metadata").first()["id"]


def batch_folder(root: str, folder: str, run: str, batch_id: int) -> str:
    return f"{root}/{folder}/run={run}/batch={batch_id}"


TASK_BYTES = 32 << 20  # of bodies, and so much for each message beside its body:
_BESIDE = 256


def dealt_out(batch: DataFrame, task_bytes: int = TASK_BYTES) -> DataFrame:
    """The micro-batch over so many tasks that none holds more than a bounded part, however few files it came in."""
    weight = F.coalesce(F.octet_length("body"), F.lit(0)).cast("bigint") + _BESIDE
    tasks = -(-(batch.agg(F.sum(weight)).first()[0] or 0) // task_bytes)
    return batch.repartition(max(tasks, batch.sparkSession.sparkContext.defaultParallelism)) if tasks > 1 else batch


def write_batch(
    batch: DataFrame,
    batch_id: int,
    handlers: Sequence[Handler],
    root: str,
    max_attempts: int | None = None,
    run: str = "0",
) -> None:
    """Process one micro-batch and write all its results.

    The folder of a batch of a run is replaced as a whole, so a batch that runs again after a failure
    leaves its results once, and a stream with a new checkpoint leaves earlier results alone.
    """
    held: list[DataFrame] = []
    batch = dealt_out(batch)

    def hold(df: DataFrame) -> DataFrame:
        held.append(df.persist())
        return held[-1]

    try:
        done = hold(limit_attempts(process(batch, handlers, hold), max_attempts))
        _write_results(done, batch.columns, lambda folder: batch_folder(root, folder, run, batch_id))
    finally:
        for df in held:
            df.unpersist()


def _write_results(done: DataFrame, original: list[str], place: Callable[[str], str]) -> None:
    def write(rows: DataFrame, folder: str) -> None:
        rows.write.mode("overwrite").parquet(place(folder))

    write(done.select("delivery_id", "attempt", "handler", "disposition", "reason"), VERDICTS)
    write(
        done.where(F.col("outcome_key").isNotNull()).select(
            F.col("outcome_key").alias("routing_key"), F.col("outcome_body").alias("body")
        ),
        OUTCOMES,
    )
    write(done.where(F.col("disposition") == DEAD_LETTER).select(*original, "handler", "reason"), DEAD_LETTERS)
    write(done.where(F.col("disposition") == "unrouted").select(*original), UNROUTED)
    again = F.coalesce("attempt", F.lit(1)) + F.lit(1)
    write(
        done.where(F.col("disposition") == REQUEUE).withColumn("attempt", again).select(*original),
        RETRY,
    )


def run_stream(
    messages: DataFrame,
    handlers: Sequence[Handler],
    checkpoint: str,
    root: str,
    max_attempts: int | None = None,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Process what arrives; without a trigger, what has arrived.

    Include ``{root}/retry`` among the folders of ``messages`` to have requeued messages
    delivered again by the next run.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, batch_id, handlers, root, max_attempts, run_id(batch.sparkSession, checkpoint))

    return start(messages.writeStream.foreachBatch(apply), checkpoint, trigger)


def conserved(processed: DataFrame) -> DataFrame:
    """Messages per disposition; their sum is the number of deliveries."""
    return processed.groupBy("disposition").agg(F.count(F.lit(1)).alias("messages"))


__all__ = ["ACK", "conserved", "limit_attempts", "run_stream", "write_batch"]
