"""Queue messages with exchange, routing key and raw body."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from jobtide.operators.messages import MESSAGE_SCHEMA


def read_messages(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.schema(MESSAGE_SCHEMA).option("recursiveFileLookup", True).parquet(*paths)


def stream_messages(
    spark: SparkSession, paths: Sequence[str], max_files: int = 1000
) -> DataFrame:
    """Several message folders as one stream."""
    reader = (
        spark.readStream.schema(MESSAGE_SCHEMA)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", max_files)
    )
    return reduce(DataFrame.unionByName, [reader.parquet(p) for p in paths])


def from_kafka(records: DataFrame) -> DataFrame:
    """Kafka records (topic as exchange, key as routing key) as queue messages."""
    # a position is unique within its partition, of which a topic has far fewer than 2^15
    serial = F.shiftleft(F.col("partition").cast("bigint"), 48) + F.col("offset")
    return records.select(
        F.col("topic").alias("exchange"),
        F.col("key").cast("string").alias("routing_key"),
        serial.alias("delivery_id"),
        F.col("value").alias("body"),
        F.lit(1).alias("attempt"),
    )
