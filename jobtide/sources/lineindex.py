"""A kept index of log lines: how many lines begin in each block of each file.

To find line n of a log, or to number its lines, somebody has to count the line ends before it.  The index
keeps these counts, one row per block, together with the size and time of the file they were made from.  A file that
is as it was is never counted again, and a range of lines is read from its own blocks only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from jobtide.sources.logfiles import PACKED, list_files
from jobtide.sources.ranges import count_lines, cut_ranges, read_ranges

BLOCK = 8 << 20
_INDEX = (
    "route STRING, log STRING, path STRING, size BIGINT, last_modified TIMESTAMP, begin BIGINT, end BIGINT, "
    "first BIGINT, lines BIGINT, counted_in INT"
)
_FILE = ["route", "log", "path", "size", "last_modified"]


def read_index(spark: SparkSession, root: str, version: int) -> DataFrame:
    """One row per block: its file, bytes, the number of its first line, its lines and the version that counted them."""
    return spark.read.schema(_INDEX).parquet(f"{root}/version={version}")


def refresh_index(
    spark: SparkSession, base: str, root: str, version: int, append_only: bool = False, width: int = BLOCK
) -> DataFrame:
    """Write the index of the folder as it is now, from the version before this one and counts of what has changed.

    A changed file is counted as a whole.  With ``append_only`` (files never change but at their end) the blocks that were complete stay.
    Versions are numbered from 0; ``width`` must stay the same.  Writing a version again gives the same.
    """
    files = list_files(spark, base).where(~F.col("log").rlike(PACKED))
    before = read_index(spark, root, version - 1) if version else spark.createDataFrame([], _INDEX)
    old = before.select("path", F.col("size").alias("old_size"), F.col("last_modified").alias("old_time")).distinct()
    both = files.join(old, "path", "left")
    same = F.coalesce((F.col("size") == F.col("old_size")) & (F.col("last_modified") == F.col("old_time")), F.lit(False))
    grown = F.coalesce(F.col("size") >= F.col("old_size"), F.lit(False)) if append_only else F.lit(False)
    # bytes whose blocks are counted already
    complete = F.floor(F.col("old_size") / width) * width
    both = both.withColumn("kept", F.when(same, F.col("size")).when(grown, complete).otherwise(0).cast("bigint"))
    stay = before.drop("size", "last_modified", "route", "log").join(both.select(*_FILE, "kept"), "path").where("end <= kept")
    changed = both.where("kept < size").select(*_FILE, "kept")
    ranges = cut_ranges(changed, F.col("kept"), F.col("size"), width)
    fresh = ranges.join(count_lines(ranges), ["path", "begin"]).withColumn("counted_in", F.lit(version))
    columns = [*_FILE, "begin", "end", "lines", "counted_in"]
    blocks = stay.select(*columns).unionByName(fresh.select(*columns))
    earlier = W.partitionBy("path").orderBy("begin").rowsBetween(W.unboundedPreceding, -1)
    numbered = blocks.withColumn("first", F.coalesce(F.sum("lines").over(earlier), F.lit(0)))
    target = f"{root}/version={version}"
    numbered.select(*[c.split()[0] for c in _INDEX.split(", ")]).write.mode("overwrite").parquet(target)
    return read_index(spark, root, version)


def blocks_of(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """The blocks that hold the wanted lines: ``wanted`` has route, log, from_line and until_line (null: all that follow)."""
    until = F.coalesce("until_line", F.lit((1 << 63) - 1))
    overlap = (F.col("first") + F.col("lines") > F.col("from_line")) & (F.col("first") < until)
    return index.join(wanted.select("route", "log", "from_line", "until_line"), ["route", "log"]).where(overlap)


def lines_between(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """Route, log, line number, line and time of the wanted lines; only their blocks are read.

    A last line without an end counts, as in the listing of a whole file.
    """
    blocks = blocks_of(index, wanted).withColumn("at_start", F.lit(False))
    lines = read_ranges(blocks, opened=True).withColumn("line_no", F.col("first") + F.col("place"))
    inside = (F.col("line_no") >= F.col("from_line")) & (F.col("line_no") < F.coalesce("until_line", F.lit((1 << 63) - 1)))
    return lines.where(inside).select("route", "log", "line_no", "line", "last_modified")


def all_lines(index: DataFrame) -> DataFrame:
    """All lines of all logs in the index, also of those whose names begin with ``_`` or ``.``."""
    blocks = index.withColumn("at_start", F.lit(False))
    lines = read_ranges(blocks, opened=True)
    return lines.select("route", "log", (F.col("first") + F.col("place")).alias("line_no"), "line", "last_modified")
