"""Change events of jobs, as a table or a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

WATCH_SCHEMA = """
    type STRING,
    object STRUCT<
        kind: STRING,
        metadata: STRUCT<uid: STRING, name: STRING, namespace: STRING, resourceVersion: STRING>,
        status: STRUCT<
            active: INT, failed: INT, succeeded: INT, startTime: TIMESTAMP,
            conditions: ARRAY<STRUCT<
                type: STRING, status: STRING, lastProbeTime: TIMESTAMP,
                reason: STRING, message: STRING>>>>
"""
# with the text of lines that do not have this form
_READ_SCHEMA = f"{WATCH_SCHEMA}, _corrupt_record STRING"


def flatten_events(raw: DataFrame) -> DataFrame:
    """Watch events as flat columns, the shape all job operators expect.

    A line that is not a watch event stays as a row of its own, its text in ``broken_line``.
    """
    meta, status = F.col("object.metadata"), F.col("object.status")
    broken = F.col("_corrupt_record") if "_corrupt_record" in raw.columns else F.lit(None).cast("string")

    def condition(c: Column) -> Column:
        return F.struct(
            c["lastProbeTime"].alias("last_probe_time"),
            c["reason"].alias("reason"),
            c["message"].alias("message"),
            c["status"].alias("status"),
            c["type"].alias("type"),
        )

    return raw.select(
        meta["resourceVersion"].cast("bigint").alias("resource_version"),
        F.col("type").alias("watch_type"),
        F.col("object.kind").alias("object_kind"),
        meta["uid"].alias("uid"),
        meta["name"].alias("name"),
        meta["namespace"].alias("namespace"),
        status["active"].alias("active"),
        status["failed"].alias("failed"),
        status["succeeded"].alias("succeeded"),
        status["startTime"].alias("start_time"),
        F.transform(status["conditions"], condition).alias("conditions"),
        broken.alias("broken_line"),
    )


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return flatten_events(spark.read.schema(_READ_SCHEMA).json(path))


def stream_events(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    reader = spark.readStream.schema(_READ_SCHEMA).option("maxFilesPerTrigger", max_files)
    return flatten_events(reader.json(path))


def stream_deduplicated(events: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Drop redeliveries of a change that arrive within the delay.

    The delay counts from the arrival of an event, as a job that has not started yet has no
    time of its own.
    """
    return (
        events.withColumn("received_at", F.current_timestamp())
        .withWatermark("received_at", delay)
        .dropDuplicatesWithinWatermark(["uid", "resource_version"])
    )
