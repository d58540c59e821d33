"""Reading the given tables and intermediate results in the shared folder."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from jobtide.session import run_dir

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts the lineage, outlives executors."""
    folder = run_dir(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Let each job that runs inside remove its shuffle files when it ends, not when the driver's heap happens to be collected.

    For jobs whose results are written or collected: a table that was written is read from its folder from then on.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


class Scratch:
    """Intermediate tables of one run in the shared folder, which go when nothing reads them any more."""

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark, self.folder, self.count = spark, run_dir(spark, purpose), 0

    def store(self, df: DataFrame, name: str) -> DataFrame:
        """Write a table and read it back."""
        self.count += 1
        folder = f"{self.folder}/{self.count}-{name}"
        with shuffles_freed(self.spark):
            df.write.option("compression", "zstd").parquet(folder)
        return self.spark.read.schema(df.schema).parquet(folder)

    def discard(self) -> None:
        """Remove the tables; only tables written elsewhere may depend on them."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Hand at most so many rows at once to Python, for jobs that run inside: bounds what tasks hold of long texts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if not 0 < int(before) <= rows:
        spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column), F.lit(""))
