"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings that operators rely on; none of them depends on data size.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a later duplicate key in a JSON object replaces the earlier one
    "spark.sql.variant.allowDuplicateKeys": "true",
}
# Number of tasks over which the rows of the given tables are dealt out before costly work on
# each row.  Not set, rows stay in the splits they are read in, and nothing is shuffled.
SPREAD_TASKS = "spark.jobtide.spreadTasks"


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str | int = "*", app: str = "jobtide", **settings: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config(SPREAD_TASKS, str(os.cpu_count() if cores == "*" else cores))
    )
    for key, value in {**RUNTIME_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster (``spark.checkpoint.dir``).

    Only a local session may name none: a temporary folder is then made and recorded in the
    session, so that every caller sees the same one.  On a cluster that would be a folder that
    other machines do not have, so it is an error there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        folder = tempfile.mkdtemp(prefix="jobtide-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def run_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for one run inside the shared folder."""
    return f"{shared_dir(spark)}/jobtide/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back.

    For input that a plan reads several times and that is costly to make.  It survives the
    loss of executors, and each reader takes only the columns it needs.
    """
    folder = run_dir(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


@contextmanager
def held(df: DataFrame, folder: str) -> Iterator[DataFrame]:
    """A table that a job reads several times, in a folder of its own while that lasts.

    Executors hold none of it: what is cached beyond their memory goes through Java's serializer, which keeps a hundred
    batches of columns at a time, outside of what Spark counts.
    """
    try:
        df.write.mode("overwrite").parquet(folder)
        yield df.sparkSession.read.schema(df.schema).parquet(folder)
    finally:
        context = df.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def pin_splits(spark: SparkSession) -> None:
    """Fix the split planning of file scans for this session.

    Spark derives the split size from the current number of cores unless
    ``spark.sql.files.minPartitionNum`` is set.  Two scans of the same files must be cut
    alike even when executors come and go in between.
    """
    key = "spark.sql.files.minPartitionNum"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(max(2, spark.sparkContext.defaultParallelism)))
