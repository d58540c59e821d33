"""Log inventory, lines, tails and links."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from jobtide import fixed
from jobtide.functions.text import iso_offset, log_link, size_text
from jobtide.operators.skew import skew_join

_LOG = ("route", "log")
PAGE_LINES = 1000


# --- inventory -------------------------------------------------------------------------


def list_routes(files: DataFrame, with_pointers: bool = True) -> DataFrame:
    """Names of the routes; hidden ones are left out."""
    shown = files.select("route").where(~F.col("route").startswith("."))
    if not with_pointers:
        shown = shown.where(F.col("route") != fixed.POINTER_DIR)
    return shown.distinct()


def list_logs(files: DataFrame, zone: str = fixed.LOG_ZONE) -> DataFrame:
    """Name, size and time of each log, with display texts."""
    return files.select(
        "route",
        F.col("log").alias("name"),
        "size",
        "last_modified",
        size_text(F.col("size")).alias("size_text"),
        iso_offset(F.col("last_modified"), zone).alias("modified_text"),
    )


# --- lines -------------------------------------------------------------------------------


def split_lines(texts: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """0-based lines of whole texts; a final empty piece is no line."""
    pieces = F.split(F.col(text), "\n")
    framed = F.when(
        F.element_at(pieces, -1) == "", F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    ).otherwise(pieces)
    return texts.select(*keys, F.posexplode(framed).alias("line_no", "line")).withColumn(
        "line_no", F.col("line_no").cast("bigint")
    )


def lines_from(lines: DataFrame, from_line: Column, skip_short: bool = False) -> DataFrame:
    """Lines at or after a position, without lines of one character or none if wanted."""
    kept = lines.where(F.col("line_no") >= from_line)
    return kept.where(F.length("line") > 1) if skip_short else kept


def limit_lines(lines: DataFrame, limit: int = fixed.LINE_LIMIT_BYTES) -> DataFrame:
    """Flag lines beyond the frame limit and show no more of them than the limit.

    The full text stays in ``line``; ``shown`` holds the part within the limit.
    """
    size = F.octet_length("line")
    raw = F.encode("line", "UTF-8")
    # a character has at most four bytes: one of these cuts falls between two characters
    cuts = [F.substring(raw, 1, limit - back).cast("string") for back in range(4)]
    cut = F.coalesce(*[F.try_validate_utf8(c) for c in cuts], F.make_valid_utf8(cuts[0]))
    return lines.withColumns(
        {
            "line_bytes": size.cast("bigint"),
            "over_limit": size > limit,
            "shown": F.when(size > limit, cut).otherwise(F.col("line")),
        }
    )


# --- tail ----------------------------------------------------------------------------------


def new_lines(lines: DataFrame, cursors: DataFrame, hot: Sequence[int] | None = None) -> DataFrame:
    """Lines at or after the cursor of their log; logs without a cursor from the start."""
    known = cursors.select(*_LOG, "next_line")
    joined = skew_join(lines, known, _LOG, "left", hot)
    return joined.where(F.col("line_no") >= F.coalesce("next_line", F.lit(0)))


def tail_pages(fresh: DataFrame, page_lines: int = PAGE_LINES) -> DataFrame:
    """New lines in pages of bounded length, each with its place in the log.

    A log with very many new lines becomes many pages, never one array; nothing is cut off.
    """
    page = F.floor(F.col("line_no") / F.lit(page_lines))
    ordered = F.array_sort(F.collect_list(F.struct("line_no", "line")))
    return (
        fresh.withColumn("page", page)
        .groupBy(*_LOG, "page")
        .agg(
            F.min("line_no").alias("from_line"),
            F.count(F.lit(1)).alias("lines"),
            F.transform(ordered, lambda e: e["line"]).alias("content"),
            F.max("last_modified").alias("last_modified"),
        )
    )


def tail_summary(fresh: DataFrame) -> DataFrame:
    """Per log: how many new lines, where to go on, when it last changed."""
    return fresh.groupBy(*_LOG).agg(
        F.count(F.lit(1)).alias("lines"),
        (F.max("line_no") + 1).alias("next_line"),
        F.max("last_modified").alias("last_modified"),
    )


def advance_cursors(cursors: DataFrame, fresh: DataFrame) -> DataFrame:
    """Cursors after a look: moved where new lines came, else unchanged."""
    moved = tail_summary(fresh).select(*_LOG, "next_line")
    return (
        cursors.select(*_LOG, "next_line")
        .unionByName(moved)
        .groupBy(*_LOG)
        .agg(F.max("next_line").alias("next_line"))
    )


# --- links -----------------------------------------------------------------------------------


def resolve_links(jobs: DataFrame, pointers: DataFrame) -> DataFrame:
    """Link to the log of each job; ``found`` is false where no pointer exists."""
    linked = pointers.select(
        "job_name", "log_path", log_link(F.col("log_path")).alias("log_url")
    )
    return jobs.join(linked, "job_name", "left").withColumn("found", F.col("log_path").isNotNull())


def missing(wanted: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """What is asked for and does not exist."""
    return wanted.join(present.select(*keys), keys, "left_anti")


def existing(wanted: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """What is asked for and exists."""
    return wanted.join(present.select(*keys), keys, "left_semi")
