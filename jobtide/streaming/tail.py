"""Incremental tail of a folder of growing logs.

The file stream source of Spark reads a file once and never looks at it again when it grows.  So each
look is a job that reads, of every log that has changed, the bytes behind its cursor: a table of byte
ranges (file, from, to) is dealt out to tasks, which open the files there (``sources/ranges.py``).  What was
delivered before is not read again, and logs of any name are read.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.streaming import StreamingQuery

from jobtide.session import written
from jobtide.sinks.files import start
from jobtide.sources.logfiles import PACKED, list_files, packed_lines
from jobtide.sources.ranges import RANGE, count_lines, cut_ranges, read_ranges

_LOG = ["route", "log"]
_CURSORS = "route STRING, log STRING, next_line BIGINT, offset BIGINT, size BIGINT, last_modified TIMESTAMP"
_LINES = "route STRING, log STRING, line_no BIGINT, line STRING, last_modified TIMESTAMP, behind BIGINT"
_FIELDS = ("next_line", "offset", "size", "last_modified")
_MARK = 3  # bytes of a byte order mark


def read_cursors(spark: SparkSession, root: str, look: int) -> DataFrame:
    """Cursor of each log after the looks before ``look``.

    ``next_line`` and ``offset`` tell what has been delivered, ``size`` and ``last_modified`` what
    the file was like then.
    """
    if look == 0:
        return spark.createDataFrame([], _CURSORS)
    newest = F.max_by(F.struct(*_FIELDS), "look").alias("newest")
    return (
        spark.read.schema(f"{_CURSORS}, look INT")
        .parquet(f"{root}/cursors")
        .where(F.col("look") < look)
        .groupBy(*_LOG)
        .agg(newest)
        .select(*_LOG, "newest.*")
    )


def changed_files(files: DataFrame, cursors: DataFrame, final: bool = False) -> DataFrame:
    """Files that are new or differ from their own cursor in size or time.

    A file smaller than what was delivered of it has been replaced and starts again.  With
    ``final`` also files of which something was held back.
    """
    seen = cursors.select(*_LOG, "next_line", "offset", F.col("size").alias("seen_size"), F.col("last_modified").alias("seen_time"))
    both = files.join(seen, _LOG, "left")
    same = F.coalesce((F.col("size") == F.col("seen_size")) & (F.col("last_modified") == F.col("seen_time")), F.lit(False))
    wanted = ~same | (F.col("offset") < F.col("size")) if final else ~same
    replaced = F.col("size") < F.coalesce("offset", F.lit(0))
    return both.where(wanted).select(
        *_LOG,
        "path",
        "size",
        "last_modified",
        F.when(replaced, 0).otherwise(F.coalesce("next_line", F.lit(0))).cast("bigint").alias("from_line"),
        F.when(replaced, 0).otherwise(F.coalesce("offset", F.lit(0))).cast("bigint").alias("from_offset"),
    )


def complete_lines(lines: Column, text_bytes: Column, size: Column, packed: Column) -> Column:
    """How many of a file's lines were ended when its size was taken, for lines read by Spark's reader.

    ``text_bytes`` counts one line end for each line: it equals the size when the last line is ended and
    is one more when that is open (less a byte order mark, which the reader leaves out).  Of a
    file that has grown since, at most two lines reach beyond that size.
    """
    ended = packed | text_bytes.isin(0) | (text_bytes == size) | (text_bytes == size - _MARK)
    unsure = F.when(text_bytes <= size + 1, 1).otherwise(2)
    return F.when(ended, lines).otherwise(F.greatest(F.lit(0), lines - unsure))


def unread_ranges(changed: DataFrame, width: int = RANGE) -> DataFrame:
    """The bytes behind each cursor, in ranges of ``width`` at most, with ``first``: the number of their first line.

    Only what was appended in more than one range is counted before it is read.
    """
    plain = changed.where(~F.col("log").rlike(PACKED))
    ranges = cut_ranges(plain, F.col("from_offset"), F.col("size"), width)
    ranges = ranges.withColumn("at_start", F.col("begin") == F.col("from_offset"))
    many = F.floor(F.col("from_offset") / width) < F.floor((F.col("size") - 1) / width)
    counted = count_lines(ranges.where(many))
    # a line that begins at the cursor is no line of the range before
    numbered = ranges.join(counted, ["path", "begin"], "left").withColumn("lines", F.coalesce("lines", F.lit(0)))
    earlier = W.partitionBy("path").orderBy("begin").rowsBetween(W.unboundedPreceding, -1)
    return numbered.withColumn("first", F.col("from_line") + F.coalesce(F.sum("lines").over(earlier), F.lit(0))).drop("lines", "is_open")


def tail_once(spark: SparkSession, base: str, root: str, look: int, final: bool = False, width: int = RANGE) -> DataFrame:
    """Write the lines that are new since the last look, move the cursors, return the lines.

    Each log is judged by its own cursor, never by the time of another one.  A line is delivered
    once its end is in the file; an open last line waits for its end.  ``final`` delivers open
    lines as they are, for logs that nobody writes any more.  Lines are written first and the
    cursors are derived from what was written; a look that fails in between is done again under
    the same number.  The ranges that a look reads are kept beside its lines.
    """
    changed = written(changed_files(list_files(spark, base), read_cursors(spark, root, look), final), "changed-logs")
    target = f"{root}/lines/look={look}"
    unread_ranges(changed, width).write.mode("overwrite").parquet(f"{root}/ranges/look={look}")
    ranges = spark.read.parquet(f"{root}/ranges/look={look}")
    lines = read_ranges(ranges, opened=final).select(*_LOG, (F.col("first") + F.col("place")).alias("line_no"), "line", "last_modified", "behind")
    packed = packed_lines(spark, changed.where(F.col("log").rlike(PACKED) & (F.col("size") > 0))).where("line_no >= from_line")
    lines = lines.unionByName(packed.select(*_LOG, "line_no", "line", "last_modified", F.col("size").alias("behind")))
    lines.write.mode("overwrite").parquet(target)
    fresh = spark.read.schema(_LINES).parquet(target)
    delivered = fresh.groupBy(*_LOG).agg((F.max("line_no") + 1).alias("next"), F.max("behind").alias("behind"))
    moved = changed.join(delivered, _LOG, "left").select(
        *_LOG,
        F.coalesce("next", "from_line").alias("next_line"),
        F.coalesce("behind", "from_offset").alias("offset"),
        "size",
        "last_modified",
    )
    moved.write.mode("overwrite").parquet(f"{root}/cursors/look={look}")
    return fresh.drop("behind")


def run_tail(
    spark: SparkSession, base: str, root: str, checkpoint: str, trigger: Mapping[str, object], width: int = RANGE
) -> StreamingQuery:
    """Look again and again, at the trigger's interval, such as ``{"processingTime": "3 seconds"}``.

    The number of the micro-batch is the number of the look, so a look that was cut off is done again after a restart.
    """
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()

    def look(_: DataFrame, batch_id: int) -> None:
        tail_once(spark, base, root, batch_id, width=width)

    return start(ticks.writeStream.foreachBatch(look), checkpoint, trigger)
