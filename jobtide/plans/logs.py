"""Queries over log folders, lines, tails and links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from jobtide import fixed
from jobtide.functions.text import age_seconds, in_base
from jobtide.operators import logs
from jobtide.plans.adapters import table, view, with_views
from jobtide.session import run_dir
from jobtide.sinks.files import write_listing, write_pointers
from jobtide.sources import lineindex, logfiles
from jobtide.sources.ranges import write_files

_NOW = "TIMESTAMP '2024-06-01 00:00:00'"


def route_listing(spark, sf):
    return logs.list_routes(view(spark, sf, "log_files")).orderBy("route")


ROUTES_SQL = with_views("log_files") + """
SELECT DISTINCT route FROM log_files WHERE route NOT LIKE '.%' ORDER BY route"""


def log_listing(spark, sf):
    return logs.list_logs(view(spark, sf, "log_files")).drop("last_modified")


_UNIT = 'least(4, CASE WHEN size > 1099511627776 THEN 4 WHEN size > 1073741824 THEN 3 WHEN size > 1048576 THEN 2 WHEN size > 1024 THEN 1 ELSE 0 END)'
_LOCAL = "timezone('Europe/London', timezone('UTC', last_modified))"
LISTING_SQL = with_views(
    "log_files",
    scaled=f"SELECT *, {_UNIT} AS u, size / pow(1024, {_UNIT}) AS v, {_LOCAL} AS wall FROM log_files",
) + """
SELECT route, log AS name, size,
    regexp_replace(CAST(CASE WHEN v < 10 THEN round(v, 2) WHEN v < 100 THEN round(v, 1) WHEN v < 1000 THEN round(v, 0)
        WHEN v < 1024 THEN round(v / 10, 0) * 10 ELSE v END AS VARCHAR), '\\.0$', '')
        || ' ' || (['bytes', 'Kb', 'Mb', 'Gb', 'Tb'])[u + 1] AS size_text,
    strftime(wall, '%Y-%m-%dT%H:%M:%S') || CASE WHEN wall = last_modified THEN 'Z' ELSE '+01:00' END AS modified_text
FROM scaled"""


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return logs.split_lines(view(spark, sf, "log_files"), "text", ["route", "log", "doc_id"])


_SPLIT = """SELECT route, log, doc_id, CAST(i - 1 AS BIGINT) AS line_no, pieces[i] AS line
    FROM (SELECT *, unnest(range(1, len(pieces) + CASE WHEN pieces[-1] = '' THEN 0 ELSE 1 END)) AS i
        FROM (SELECT route, log, doc_id, string_split(text, chr(10)) AS pieces FROM log_files))"""


def log_lines_from(spark, sf):
    fresh = logs.lines_from(_lines(spark, sf), F.col("doc_id") % 5, skip_short=True)
    return fresh.select("route", "log", "line_no", "line")


LINES_FROM_SQL = with_views("log_files", lines=_SPLIT) + """
SELECT route, log, line_no, line FROM lines WHERE line_no >= doc_id % 5 AND length(line) > 1"""


def long_lines(spark, sf):
    limited = logs.limit_lines(_lines(spark, sf))
    return limited.where("over_limit").select(
        "route", "log", "line_no", "line_bytes", F.length("shown").cast("bigint").alias("shown_chars")
    )


LONG_SQL = with_views("log_files", lines=_SPLIT) + """
SELECT route, log, line_no, strlen(line) AS line_bytes,
    (SELECT max(k) FROM range(8192, 32769) AS t(k) WHERE strlen(left(line, k)) <= 32768) AS shown_chars
FROM lines WHERE strlen(line) > 32768"""


def line_lengths(spark, sf):
    limited = logs.limit_lines(_lines(spark, sf))
    return limited.groupBy("route", "over_limit").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum("line_bytes").cast("bigint").alias("total_bytes"),
        F.max("line_bytes").alias("longest"),
    )


LENGTHS_SQL = with_views("log_files", lines=_SPLIT) + """
SELECT route, strlen(line) > 32768 AS over_limit, count(*) AS lines, CAST(sum(strlen(line)) AS BIGINT) AS total_bytes,
    max(strlen(line)) AS longest FROM lines GROUP BY 1, 2"""


def log_ages(spark, sf):
    files = view(spark, sf, "log_files")
    age = age_seconds(F.col("last_modified").cast("timestamp"), F.expr(_NOW))
    return files.select("route", "log", age.alias("age_seconds"), (age < 0).alias("is_future"))


AGES_SQL = with_views("log_files") + f"""
SELECT route, log, CAST(epoch({_NOW}) - epoch(last_modified) AS BIGINT) AS age_seconds, last_modified > {_NOW} AS is_future
FROM log_files"""


# --- tail ------------------------------------------------------------------------------------

# A log in nine has no cursor yet.
_NEXT = "conv_id % 4"
_NO_CURSOR = "conv_id % 9 = 0"


def _tail(spark, sf):
    lines = view(spark, sf, "tail_lines")
    cursors = (
        lines.where(f"NOT ({_NO_CURSOR})")
        .select("route", "log", F.expr(_NEXT).alias("next_line"))
        .distinct()
    )
    return lines, cursors


def log_tail_chunk(spark, sf):
    fresh = logs.new_lines(*_tail(spark, sf))
    pages = logs.tail_pages(fresh, page_lines=3)
    return pages.select(
        "route", "log", "page", "from_line", "lines",
        F.array_join("content", "\n").alias("content"),
        F.date_format("last_modified", "yyyy-MM-dd HH:mm:ss").alias("last_modified"),
    )


_FRESH = f"SELECT * FROM tail_lines WHERE line_no >= CASE WHEN {_NO_CURSOR} THEN 0 ELSE {_NEXT} END"
TAIL_SQL = with_views("tail_lines", fresh=_FRESH) + """
SELECT route, log, line_no // 3 AS page, min(line_no) AS from_line, count(*) AS lines,
    string_agg(line, chr(10) ORDER BY line_no) AS content, strftime(max(last_modified), '%Y-%m-%d %H:%M:%S') AS last_modified
FROM fresh GROUP BY 1, 2, 3"""


def tail_cursors(spark, sf):
    lines, cursors = _tail(spark, sf)
    return logs.advance_cursors(cursors, logs.new_lines(lines, cursors))


CURSORS_SQL = with_views("tail_lines", fresh=_FRESH) + f"""
SELECT route, log, max(n) AS next_line FROM (
    SELECT route, log, line_no + 1 AS n FROM fresh
    UNION ALL SELECT route, log, {_NEXT} FROM tail_lines WHERE NOT ({_NO_CURSOR})) GROUP BY 1, 2"""


# --- links -----------------------------------------------------------------------------------


def _jobs(spark, sf):
    return table(spark, sf, "documents").select(
        F.concat(F.lit(fixed.JOB_PREFIX), F.col("doc_id").cast("string")).alias("job_name")
    )


def job_log_links(spark, sf):
    linked = logs.resolve_links(_jobs(spark, sf), view(spark, sf, "log_pointers"))
    inside = in_base(F.trim(F.regexp_replace("log_path", "\n", "")), fixed.LOG_PATH_PREFIX)
    return linked.select("job_name", "log_url", "found", inside.alias("in_base"))


LINKS_SQL = with_views("log_pointers") + """
SELECT 'cds-' || CAST(d.doc_id AS VARCHAR) AS job_name,
    regexp_replace(replace(log_path, '/var/log/cds_backend/', '/log/'), '\\s', '', 'g') AS log_url,
    log_path IS NOT NULL AS found, CASE WHEN log_path IS NOT NULL THEN d.doc_id % 11 <> 0 END AS in_base
FROM documents d LEFT JOIN log_pointers p ON p.doc_id = d.doc_id"""


def missing_logs(spark, sf):
    return logs.missing(_jobs(spark, sf), view(spark, sf, "log_pointers"), ["job_name"])


MISSING_SQL = """
SELECT 'cds-' || CAST(doc_id AS VARCHAR) AS job_name FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"""


def existing_logs(spark, sf):
    return logs.existing(_jobs(spark, sf), view(spark, sf, "log_pointers"), ["job_name"])


EXISTING_SQL = """
SELECT 'cds-' || CAST(doc_id AS VARCHAR) AS job_name FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)"""


# --- real files ------------------------------------------------------------------------------


def _written_logs(spark: SparkSession, sf: str) -> str:
    """The texts as log files, one file per route in the order of the documents."""
    folder = run_dir(spark, "logs")
    texts = table(spark, sf, "documents").select(F.col("source").alias("route"), "doc_id", "text")
    ordered = texts.repartition("route").sortWithinPartitions("route", "doc_id")
    ordered.select("route", "text").write.partitionBy("route").text(folder)
    return folder


def _plain_route() -> Column:
    return F.regexp_replace("route", "^route=", "")


def log_file_lines(spark, sf):
    """Lines of log files with their numbers."""
    lines = logfiles.read_lines(spark, _written_logs(spark, sf))
    return lines.select(_plain_route().alias("route"), "line_no", F.md5("line").alias("line_md5"))


# Every text is written with a line end behind it.
_FILE_LINES = """SELECT source AS route, row_number() OVER (PARTITION BY source ORDER BY doc_id, i) - 1 AS line_no, pieces[i] AS line
    FROM (SELECT source, doc_id, pieces, unnest(range(1, len(pieces) + 1)) AS i
        FROM (SELECT source, doc_id, string_split(text, chr(10)) AS pieces FROM documents))"""
FILE_LINES_SQL = f"""
SELECT route, line_no, md5(line) AS line_md5 FROM ({_FILE_LINES})"""


def lines_in_file_order(spark, sf):
    """The whole folder in file order: each line next to the one before it."""
    ordered = logfiles.in_file_order(logfiles.read_lines(spark, _written_logs(spark, sf)))
    return ordered.select(_plain_route().alias("route"), "line_no", F.length("line").cast("bigint").alias("characters"))


ORDER_SQL = f"""
SELECT route, line_no, length(line) AS characters FROM ({_FILE_LINES}) ORDER BY route, line_no"""


def route_directories(spark, sf):
    """Routes, files and sizes as found in the folder, markers and empty files too; nothing is read."""
    files = logfiles.list_files(spark, _written_logs(spark, sf))
    shown = files.where(~F.col("route").startswith("."))
    return shown.groupBy(_plain_route().alias("route")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("size").cast("bigint").alias("size")
    )


DIRECTORIES_SQL = """
SELECT source AS route, CAST(1 AS BIGINT) AS files, CAST(sum(strlen(text) + 1) AS BIGINT) AS size FROM documents GROUP BY 1"""


def pointer_links(spark, sf):
    """Pointer files written, read and joined to the jobs they belong to."""
    folder = run_dir(spark, "pointers")
    pointers = view(spark, sf, "log_pointers")
    write_pointers(pointers.select("job_name", "log_path"), folder)
    linked = logs.resolve_links(_jobs(spark, sf), logfiles.read_pointers(spark, folder))
    return linked.select("job_name", "log_url", "found")


POINTERS_SQL = with_views("log_pointers") + """
SELECT 'cds-' || CAST(d.doc_id AS VARCHAR) AS job_name,
    regexp_replace(replace(log_path, '/var/log/cds_backend/', '/log/'), '\\s', '', 'g') AS log_url, log_path IS NOT NULL AS found
FROM documents d LEFT JOIN log_pointers p ON p.doc_id = d.doc_id"""


def _odd_logs(spark: SparkSession, sf: str) -> str:
    """The texts as log files of which some have names that begin with ``_`` or ``.``: one per route and language."""
    folder = run_dir(spark, "odd-logs")
    texts = table(spark, sf, "documents").where("text is not null")
    name = F.concat(F.element_at(F.create_map(F.lit("en"), F.lit("_"), F.lit("de"), F.lit("."), F.lit("fr"), F.lit("")), "lang"), F.col("lang"), F.lit("/"), F.col("doc_id"))
    path = F.concat(F.lit(f"{folder}/"), "source", F.lit("/"), F.coalesce(name, F.concat(F.lit("other/."), F.col("doc_id"))))
    write_files(texts.select(path.alias("path"), F.col("text").alias("content")))
    return folder


def indexed_lines(spark, sf):
    """Lines of logs of any name by an index of their blocks; a second index of the same files counts nothing."""
    folder, root = _odd_logs(spark, sf), run_dir(spark, "line-index")
    for version in (0, 1):
        index = lineindex.refresh_index(spark, folder, root, version, width=1 << 14)
    again = index.where("counted_in = 1").agg(F.count(F.lit(1)).alias("counted_again"))
    lines = lineindex.all_lines(index)
    shown = lines.select("route", F.regexp_extract("log", r"([0-9]+)$", 1).cast("bigint").alias("doc_id"), "line_no", F.md5("line").alias("line_md5"))
    return shown.withColumn("counted_again", F.lit(again.first()[0]))


_TEXT_LINES = """SELECT source AS route, doc_id, pieces, unnest(range(1, len(pieces) + CASE WHEN pieces[-1] = '' THEN 0 ELSE 1 END)) AS i
    FROM (SELECT source, doc_id, string_split(text, chr(10)) AS pieces FROM documents WHERE text IS NOT NULL)"""
INDEXED_SQL = f"""
SELECT route, doc_id, CAST(i - 1 AS BIGINT) AS line_no, md5(pieces[i]) AS line_md5, CAST(0 AS BIGINT) AS counted_again FROM ({_TEXT_LINES})"""


def indexed_lines_from(spark, sf):
    """The lines from a given one on, of each log; blocks before it are not read."""
    folder = _odd_logs(spark, sf)
    index = lineindex.refresh_index(spark, folder, run_dir(spark, "line-index"), 0, width=1 << 14)
    number = F.regexp_extract("log", r"([0-9]+)$", 1).cast("bigint")
    wanted = index.select("route", "log").distinct().select("route", "log", (number % 40).alias("from_line"), (number % 40 + 25).alias("until_line"))
    lines = lineindex.lines_between(index, wanted)
    return lines.select("route", number.alias("doc_id"), "line_no", F.md5("line").alias("line_md5"))


INDEXED_FROM_SQL = f"""
SELECT route, doc_id, CAST(i - 1 AS BIGINT) AS line_no, md5(pieces[i]) AS line_md5 FROM ({_TEXT_LINES})
WHERE i - 1 >= doc_id % 40 AND i - 1 < doc_id % 40 + 25"""


def listing_ndjson(spark, sf):
    """The listing written as one JSON object per line and read back."""
    folder = run_dir(spark, "listing")
    write_listing(view(spark, sf, "log_files"), folder)
    return logfiles.read_listing(spark, folder).withColumnRenamed("lastModified", "last_modified")


NDJSON_SQL = with_views("log_files", walls=f"SELECT *, {_LOCAL} AS wall FROM log_files") + """
SELECT log AS name, size, strftime(wall, '%Y-%m-%dT%H:%M:%S')
    || CASE WHEN wall = last_modified THEN 'Z' ELSE '+01:00' END || '[Europe/London]' AS last_modified FROM walls"""

QUERIES = {
    "route_listing": (route_listing, ROUTES_SQL),
    "log_listing": (log_listing, LISTING_SQL),
    "log_lines_from": (log_lines_from, LINES_FROM_SQL),
    "long_lines": (long_lines, LONG_SQL),
    "line_lengths": (line_lengths, LENGTHS_SQL),
    "log_ages": (log_ages, AGES_SQL),
    "log_tail_chunk": (log_tail_chunk, TAIL_SQL),
    "tail_cursors": (tail_cursors, CURSORS_SQL),
    "job_log_links": (job_log_links, LINKS_SQL),
    "missing_logs": (missing_logs, MISSING_SQL),
    "existing_logs": (existing_logs, EXISTING_SQL),
    "log_file_lines": (log_file_lines, FILE_LINES_SQL),
    "lines_in_file_order": (lines_in_file_order, ORDER_SQL),
    "pointer_links": (pointer_links, POINTERS_SQL),
    "route_directories": (route_directories, DIRECTORIES_SQL),
    "listing_ndjson": (listing_ndjson, NDJSON_SQL),
    "indexed_lines": (indexed_lines, INDEXED_SQL),
    "indexed_lines_from": (indexed_lines_from, INDEXED_FROM_SQL),
}
