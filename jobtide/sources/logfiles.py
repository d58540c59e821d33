"""Log folders: files, lines, pointer files."""

from __future__ import annotations

import posixpath
import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from jobtide import fixed
from jobtide.session import ensure_checkpoint_dir, pin_splits
from jobtide.sources.ranges import cut_ranges, list_tree, partition_value, read_files, read_packed, read_ranges

# Rows of the block index that one broadcast carries (about 100 bytes each).
BLOCKS_PER_BROADCAST = 2_000_000


def _relative(path: Column, base: str, encoded: bool) -> Column:
    """Path below the base folder.  Paths from file metadata are URI-encoded."""
    plain = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", base).rstrip("/")
    if encoded:
        path = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    below = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?)?" + re.sub(r"([^A-Za-z0-9_/])", r"\\\1", plain) + "/+(.+)$"
    return F.regexp_extract(path, below, 1)


def _route_and_log(relative: Column) -> dict[str, Column]:
    return {
        "route": F.split_part(relative, F.lit("/"), F.lit(1)),
        "log": F.regexp_replace(relative, "^[^/]*/", ""),
    }


# Spark's text reader unpacks these; the size of such a file says nothing about its text.
PACKED = r"\.(?:gz|bz2|deflate|lz4|snappy|zst)$"
# of these, the forms that only Spark's reader knows
_ONLY_SPARK = r"\.(?:lz4|snappy)$"


def list_files(spark: SparkSession, base: str) -> DataFrame:
    """Route, log, path, size and time of each file, also of empty and of ``_`` or ``.`` names.

    Folders are listed by tasks, level by level; contents are not read.  Spark's own listing is
    not used because it passes over empty files and over such names, and lists in the driver.
    """
    return (
        list_tree(spark, base)
        .withColumn("__rel", _relative(F.col("path"), base, encoded=False))
        .where(F.col("__rel").contains("/") & ~F.col("__rel").rlike(r"(?:^|/)\.[^/]*\.crc$"))
        .select(*[c.alias(n) for n, c in _route_and_log(F.col("__rel")).items()], "path", "size", "last_modified")
    )


def raw_lines(spark: SparkSession, base: str, paths: Sequence[str] | None = None) -> DataFrame:
    """Lines as the scan gives them, with file, block and row id.  Only of ``paths`` if given."""
    pin_splits(spark)
    ensure_checkpoint_dir(spark)
    reader = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).option("ignoreMissingFiles", True)
    plain = [re.sub(r"([{}\[\]*?\\])", r"\\\1", path) for path in paths] if paths is not None else base
    return reader.text(plain).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("__path"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.col("_metadata.file_modification_time").alias("last_modified"),
        F.monotonically_increasing_id().alias("__row"),
    )


def block_index(raw: DataFrame, base: str) -> DataFrame:
    """One row per block: its lines and bytes, and what turns a row id into a line number."""
    earlier = W.partitionBy("__path").orderBy("__block").rowsBetween(W.unboundedPreceding, -1)
    return (
        raw.groupBy("__path", "__block")
        .agg(
            F.min("__row").alias("__first"),
            F.count(F.lit(1)).alias("__lines"),
            F.sum(F.octet_length("line") + F.lit(1)).alias("__bytes"),
        )
        .withColumn("__shift", F.coalesce(F.sum("__lines").over(earlier), F.lit(0)) - F.col("__first"))
        .withColumn("__rel", _relative(F.col("__path"), base, encoded=True))
        .where(F.col("__rel").contains("/"))
        .select("__path", "__block", "__shift", "__lines", "__bytes", *[c.alias(n) for n, c in _route_and_log(F.col("__rel")).items()])
        .checkpoint()
    )


def number_lines(raw: DataFrame, blocks: DataFrame, base: str, per_log: DataFrame | None = None) -> DataFrame:
    """Route, log, line number and line; with the columns of ``per_log`` (one row per route and log).

    The block index travels to the lines, never the lines to the index: a row of it is two hashes of the
    path, the block and a few numbers.  An index too large for one broadcast is sent in parts, each to the
    lines of its own files, which reads the files once per part and still shuffles no text.
    """
    more = []
    if per_log is not None:
        more = [c for c in per_log.columns if c not in ("route", "log")]
        blocks = blocks.join(per_log, ["route", "log"], "left")
    marks = [F.xxhash64("__path").alias("__key"), F.crc32("__path").alias("__check")]
    parts = -(-blocks.count() // BLOCKS_PER_BROADCAST) or 1
    index = blocks.select(*marks, "__block", "__shift", *more)
    keyed = raw.select("*", *marks)

    def joined(part: int) -> DataFrame:
        mine = F.pmod("__key", F.lit(parts)) == part
        return keyed.where(mine).join(F.broadcast(index.where(mine)), ["__key", "__check", "__block"])

    whole = reduce(DataFrame.unionAll, [joined(part) for part in range(parts)])
    place = _route_and_log(_relative(F.col("__path"), base, encoded=True))
    return whole.select(
        *[c.alias(n) for n, c in place.items()],
        (F.col("__row") + F.col("__shift")).alias("line_no"),
        "line",
        "last_modified",
        *more,
    )


def read_lines(spark: SparkSession, base: str, per_log: DataFrame | None = None) -> DataFrame:
    """All log lines with route, log, 0-based line number and time of the file.

    Files are read split by split.  A first pass counts the lines of each split; the running sum of
    these counts per file gives the number of lines before a split.  A line's own place in its split
    follows from the row ids of the scan, so the text is neither shuffled nor sorted.
    """
    raw = raw_lines(spark, base)
    return number_lines(raw, block_index(raw, base), base, per_log)


def packed_lines(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Lines of packed files with the columns of ``files`` (one row per file) and ``line_no``; a file is one unit of work."""
    mine = files.where(~F.col("path").rlike(_ONLY_SPARK))
    lines = read_packed(mine).withColumnRenamed("place", "line_no")
    others = files.where(F.col("path").rlike(_ONLY_SPARK))
    # two rare forms, whose names Spark's reader wants in the driver
    paths = [row["path"] for row in others.select("path").collect()]
    if paths:
        base = posixpath.commonpath([posixpath.dirname(posixpath.dirname(path)) for path in paths])
        raw = raw_lines(spark, base, paths)
        numbered = number_lines(raw, block_index(raw, base), base).select("route", "log", "line_no", "line")
        lines = lines.unionByName(numbered.join(others, ["route", "log"]).select(*lines.columns))
    return lines


def in_file_order(lines: DataFrame) -> DataFrame:
    """Lines sorted by route, log and place."""
    return lines.orderBy("route", "log", "line_no")


def read_pointers(spark: SparkSession, base: str) -> DataFrame:
    """Job name and content of each pointer file; listed and read by tasks."""
    folder = f"{base.rstrip('/')}/{fixed.POINTER_DIR}"
    files = list_tree(spark, folder).where(F.col("path").endswith(fixed.POINTER_SUFFIX))
    name = F.regexp_extract("path", r"([^/]*)\.txt$", 1)
    return read_files(files).select(
        F.coalesce(F.try_url_decode(name), name).alias("job_name"), F.col("content").alias("log_path")
    )


def read_pod_logs(spark: SparkSession, base: str) -> DataFrame:
    """job_name, pod_name and line of archived pod logs; listed and read by tasks."""
    files = list_tree(spark, base).where(~F.col("path").rlike(r"/[._][^/]*$")).withColumn("at_start", F.lit(False))
    lines = read_ranges(cut_ranges(files, F.lit(0), F.col("size")), opened=True)
    return lines.select(*[partition_value(F.col("path"), c).alias(c) for c in ("job_name", "pod_name")], "line")


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    """A log listing in one-object-per-line JSON."""
    return spark.read.schema("name STRING, size BIGINT, lastModified STRING").json(path)
