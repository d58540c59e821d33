"""Files listed, read by byte range and written inside tasks.

Spark's text reader takes files whole and passes over names that begin with ``_`` or ``.``.  Here a table of
ranges says what to read, so a task opens a file at a place and reads no more than its range.  Files are
opened with pyarrow's file systems (local and mounted folders, ``s3``, ``gs``, ``hdfs``); the driver opens none.
"""

from __future__ import annotations

import os
import posixpath
import re
import zlib
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from jobtide.session import written

RANGE = 64 << 20  # bytes that one task reads at once
_PIECE = 1 << 20  # bytes asked for together
_ROWS = 8192  # lines handed over together
_MARK = b"\xef\xbb\xbf"
_SCHEME = re.compile(r"^([A-Za-z][A-Za-z0-9+.-]*):(//[^/]*)?(.*)$", re.DOTALL)
_PACKED = {"gz": "gzip", "bz2": "bz2", "zst": "zstd"}
_SAME = {"s3a": "s3", "s3n": "s3"}


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path in it.  Paths are plain text, not URI-encoded."""
    parts = _SCHEME.match(path)
    if parts is None or parts[1] == "file":
        return fs.LocalFileSystem(), path if parts is None else parts[3]
    scheme, authority, below = _SAME.get(parts[1], parts[1]), parts[2] or "//", parts[3]
    system, root = fs.FileSystem.from_uri(f"{scheme}:{authority}/")
    return system, posixpath.join(root, below.lstrip("/")) if root else below


def _prefix(path: str) -> str:
    """What stands before the path that the file system knows."""
    parts = _SCHEME.match(path)
    return "" if parts is None else f"{parts[1]}:{parts[2] or ''}"


# --- listing ---------------------------------------------------------------------------------

_LISTED = "path STRING, size BIGINT, last_modified TIMESTAMP, is_folder BOOLEAN"


def _entries(system: fs.FileSystem, folder: str) -> Iterator[tuple[str, int, int, bool]]:
    """Path, size, time in nanoseconds of what is in a folder, and whether it is a folder; these file systems give all at once."""
    for one in system.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
        yield one.path, one.size or 0, one.mtime_ns or 0, one.type == fs.FileType.Directory


def _local_entries(folder: str) -> Iterator[tuple[str, int, int, bool]]:
    """The same of a local or mounted folder, one entry after the other, however many there are."""
    try:
        found = os.scandir(folder)
    except FileNotFoundError:
        return
    with found:
        for one in found:
            try:
                state = one.stat()
            except FileNotFoundError:  # gone meanwhile
                continue
            is_folder = one.is_dir()
            yield posixpath.join(folder, one.name), 0 if is_folder else state.st_size, state.st_mtime_ns, is_folder


def _children(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for folder in batch.column(0).to_pylist():
            system, inside = file_system(folder)
            before = _prefix(folder)
            if before.startswith("s3") or before.startswith("gs"):  # their paths carry the bucket
                before = before.split(":")[0] + "://"
            found = _local_entries(inside) if isinstance(system, fs.LocalFileSystem) else _entries(system, inside)
            while some := list(islice(found, _ROWS)):
                columns = [
                    pa.array([before + path for path, *_ in some], pa.string()),
                    pa.array([size for _, size, *_ in some], pa.int64()),
                    pa.array([time // 1_000_000 * 1_000 for _, _, time, _ in some], pa.int64()).cast(pa.timestamp("us", "UTC")),
                    pa.array([is_folder for *_, is_folder in some], pa.bool_()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["path", "size", "last_modified", "is_folder"])


def list_tree(spark: SparkSession, base: str) -> DataFrame:
    """Path, size and time (to the millisecond) of all files below a folder, of any name.

    Level by level: tasks list the folders that the level before has found.  The driver sees whether
    there are more, never a name.
    """
    folders, levels = spark.createDataFrame([(base.rstrip("/"),)], "path STRING"), []
    while True:
        level = written(folders.mapInArrow(_children, _LISTED), "listing")
        levels.append(level.where("not is_folder").drop("is_folder"))
        below = level.where("is_folder").select("path")
        if below.isEmpty():
            break
        folders = below.repartition(spark.sparkContext.defaultParallelism)
    whole = levels[0]
    for level in levels[1:]:
        whole = whole.unionAll(level)
    return whole


# --- reading ---------------------------------------------------------------------------------


def cut_ranges(files: DataFrame, begin: Column, end: Column, width: int = RANGE) -> DataFrame:
    """The files' columns with ``begin`` and ``end`` of consecutive ranges of ``width`` bytes at most.

    Cuts lie at multiples of the width, whatever the first range begins with.
    """
    first = F.floor(begin / width)
    last = F.floor((end - 1) / width)
    steps = F.when(end > begin, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))
    cut = files.withColumns({"__begin": begin, "__end": end}).withColumn("__step", F.explode(steps))
    return cut.select(
        *files.columns,
        F.greatest(F.col("__begin"), F.col("__step") * width).alias("begin"),
        F.least(F.col("__end"), (F.col("__step") + 1) * width).alias("end"),
    )


def _spread(ranges: DataFrame) -> DataFrame:
    """Ranges dealt out so that a task has about ``RANGE`` bytes, small files together."""
    total, count = ranges.agg(F.coalesce(F.sum(F.col("end") - F.col("begin")), F.lit(0)), F.count(F.lit(1))).first()
    tasks = max(ranges.sparkSession.sparkContext.defaultParallelism, -(-total // RANGE))
    return ranges.repartition(max(1, min(tasks, count)), "path", "begin")


def _lines_of(stream, begin: int, end: int, size: int, at_start: bool, opened: bool) -> Iterator[tuple[bytes, int]]:
    """Lines that begin in a range, with the place behind each; ``size`` bounds what may be read.

    Unless ``at_start`` says that a line begins at ``begin``, the first one begins behind the next line end
    from the byte before it on.  With ``opened`` a last line without end counts, too.
    """
    known = at_start or begin == 0
    start = place = begin if known else begin - 1  # of the line, and of what is read next
    stream.seek(place)
    parts: list[bytes] = []  # of a line whose end is not read yet
    mark = 0  # bytes of a mark before the line, which belong to it
    while start < end and (piece := stream.read(min(_PIECE, size - place))):
        place += len(piece)
        if not known:
            found = piece.find(b"\n")
            if found < 0:
                start = place
                continue
            known, start, piece = True, start + found + 1, piece[found + 1 :]
        if place == len(piece) and piece.startswith(_MARK):
            mark, piece = len(_MARK), piece[len(_MARK) :]
        *ended, rest = piece.split(b"\n")
        for line in ended:
            if parts:
                line, parts = b"".join([*parts, line]), []
            if start >= end:
                return
            start, mark = start + mark + len(line) + 1, 0
            yield line, start
        if rest:
            parts.append(rest)
    if opened and parts and known and start < end:
        yield b"".join(parts), place


def _repeated(row: pa.RecordBatch, count: int) -> list[pa.Array]:
    return [pa.repeat(column[0], count) for column in row.columns]


def _handed_over(lines: Iterator, row: pa.RecordBatch, names: list[str], make) -> Iterator[pa.RecordBatch]:
    """Batches of a range's (or file's) lines, with its own columns in every row."""
    first, some = 0, []
    while some := list(islice(lines, _ROWS)):
        yield pa.RecordBatch.from_arrays([*_repeated(row, len(some)), pa.array(range(first, first + len(some)), pa.int64()), *make(some)], names)
        first += len(some)


def _schema(df: DataFrame, more: str) -> str:
    return ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema], more])


def read_ranges(ranges: DataFrame, opened: bool = False) -> DataFrame:
    """Lines that begin in each range, with the range's columns: place in the range, ``behind`` (the byte after the line) and line.

    ``ranges`` has path, begin, end, size (nothing behind it is read), at_start (a line begins at
    ``begin`` for certain) and any others.  Lines end at a line feed and keep their bytes; a byte order mark at the start of
    a file is left out.
    """
    names = [*ranges.columns, "place", "behind", "line"]

    def split(some: list[tuple[bytes, int]]) -> list[pa.Array]:
        return [pa.array([behind for _, behind in some], pa.int64()), pa.array([line for line, _ in some], pa.binary())]

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(len(batch)):
                row = batch.slice(at, 1)
                one = row.select(["path", "begin", "end", "size", "at_start"]).to_pylist()[0]
                system, inside = file_system(one["path"])
                with system.open_input_file(inside) as stream:
                    found = _lines_of(stream, one["begin"], one["end"], one["size"], one["at_start"], opened)
                    yield from _handed_over(found, row, names, split)

    made = _spread(ranges).mapInArrow(lines, _schema(ranges, "place BIGINT, behind BIGINT, line BINARY"))
    return made.withColumn("line", F.col("line").cast("string"))


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of lines that begin in each range: line ends from the byte before it to the one before its last."""
    for batch in batches:
        rows, counts, opens = batch.to_pylist(), [], []
        for one in rows:
            system, inside = file_system(one["path"])
            with system.open_input_file(inside) as stream:
                begin = max(0, one["begin"] - 1)
                stream.seek(begin)
                left, count, last = one["end"] - begin, int(one["begin"] == 0), b"\n"
                while left and (piece := stream.read(min(_PIECE, left))):
                    left -= len(piece)
                    # a line end at the last byte begins a line of the next range
                    count += piece.count(b"\n") - (not left and piece.endswith(b"\n"))
                    last = piece[-1:]
                counts.append(count)
                opens.append(last != b"\n")
        columns = [batch.column("path"), batch.column("begin"), pa.array(counts, pa.int64()), pa.array(opens, pa.bool_())]
        yield pa.RecordBatch.from_arrays(columns, ["path", "begin", "lines", "is_open"])


def count_lines(ranges: DataFrame) -> DataFrame:
    """path, begin, ``lines`` that begin in each range (none if it is empty), and whether it ends inside a line (``is_open``)."""
    wanted = ranges.where("end > begin").select("path", "begin", "end")
    return _spread(wanted).mapInArrow(_counter, "path STRING, begin BIGINT, lines BIGINT, is_open BOOLEAN")


def _packed_lines(path: str) -> Iterator[bytes]:
    system, inside = file_system(path)
    kind = path.rsplit(".", 1)[-1]
    unpack = zlib.decompressobj() if kind == "deflate" else None
    with system.open_input_stream(inside, compression=None if unpack else _PACKED[kind]) as stream:
        parts, first = [], True
        while piece := stream.read(_PIECE):
            piece = unpack.decompress(piece) if unpack else piece
            if first and piece:
                piece, first = piece.removeprefix(_MARK), False
            *ended, rest = piece.split(b"\n")
            for line in ended:
                yield b"".join([*parts, line])
                parts = []
            if rest:
                parts.append(rest)
        if parts:
            yield b"".join(parts)


def read_packed(files: DataFrame) -> DataFrame:
    """Lines of packed files (gz, bz2, zst, deflate), with the files' columns, place (from 0) and line.

    Such a file can only be read from its start, in one task.
    """
    names = [*files.columns, "place", "line"]

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(len(batch)):
                row = batch.slice(at, 1)
                path = row.column("path")[0].as_py()
                yield from _handed_over(_packed_lines(path), row, names, lambda some: [pa.array(some, pa.binary())])

    spread = files.repartition(files.sparkSession.sparkContext.defaultParallelism, "path")
    made = spread.mapInArrow(lines, _schema(files, "place BIGINT, line BINARY"))
    return made.withColumn("line", F.col("line").cast("string"))


# --- small files -----------------------------------------------------------------------------


def write_files(files: DataFrame) -> int:
    """Write one file per row (``path``, ``content``) from tasks; returns how many.

    A file appears whole: it is written under a name of its own and then moved.  Writing one again replaces it.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = set()
            for at in range(len(batch)):  # one text at a time as Python's
                path, content = batch.column(0)[at].as_py(), batch.column(1)[at].as_py()
                system, inside = file_system(path)
                folder, name = posixpath.split(inside)
                if folder not in made:
                    system.create_dir(folder, recursive=True)
                    made.add(folder)
                draft = posixpath.join(folder, f".{name}.draft")
                with system.open_output_stream(draft) as stream:
                    stream.write((content or "").encode())
                system.move(draft, inside)
            yield pa.RecordBatch.from_arrays([pa.array([len(batch)], pa.int64())], ["files"])

    done = files.select("path", "content").mapInArrow(write, "files BIGINT")
    return done.agg(F.coalesce(F.sum("files"), F.lit(0))).first()[0]


def read_files(files: DataFrame) -> DataFrame:
    """path and content (text) of small files; those that have gone meanwhile are left out."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, contents = [], []
            for path in batch.column(0).to_pylist():
                system, inside = file_system(path)
                try:
                    with system.open_input_file(inside) as stream:
                        contents.append(stream.read())
                except FileNotFoundError:
                    continue
                paths.append(path)
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(contents, pa.binary())], ["path", "content"])

    spread = files.select("path").repartition(files.sparkSession.sparkContext.defaultParallelism, "path")
    return spread.mapInArrow(read, "path STRING, content BINARY").withColumn("content", F.col("content").cast("string"))


# --- folders of lines ------------------------------------------------------------------------

_NO_NAME = "__HIVE_DEFAULT_PARTITION__"
_ESCAPED = r"""([\x01-\x1F"#%'*/:=?\\\x7F{\[\]^])"""


def partition_folder(column: str) -> Column:
    """``column=value`` as Spark names the folder of a value."""
    plain = F.regexp_replace(F.col(column).cast("string"), _ESCAPED, "\u0000$1\u0000")
    # every second piece is one character to escape
    pieces = F.transform(F.split(plain, "\u0000"), lambda piece, at: F.when(at % 2 == 1, F.concat(F.lit("%"), F.lpad(F.hex(piece), 2, "0"))).otherwise(piece))
    value = F.when(F.col(column).cast("string") == "", F.lit(_NO_NAME)).otherwise(F.array_join(pieces, ""))
    return F.concat(F.lit(f"{column}="), F.coalesce(value, F.lit(_NO_NAME)))


def partition_value(path: Column, column: str) -> Column:
    """The value that a path has a folder ``column=value`` for."""
    value = F.regexp_extract(path, f"/{column}=([^/]*)/", 1)
    return F.when(value == _NO_NAME, None).otherwise(F.url_decode(F.replace(value, F.lit("+"), F.lit("%2B"))))


def write_drafts(lines: DataFrame, run: str) -> DataFrame:
    """Write rows (``folder``, ``line``) as text, a file for each run of rows with one folder in a task; gives folder and name of each.

    Files appear under names with a dot before them, until ``publish_drafts``.  A task that runs again writes its files again.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = f"part-{TaskContext.get().partitionId():05d}-{run}"
        open_folder, stream = None, None
        try:
            for batch in batches:
                at = pc.run_end_encode(batch.column(0)) if len(batch) else None
                begin = 0
                for folder, end in zip(at.values.to_pylist(), at.run_ends.to_pylist()) if at else ():
                    if folder != open_folder:
                        if stream:
                            stream.close()
                        system, inside = file_system(folder)
                        system.create_dir(inside, recursive=True)
                        open_folder, stream = folder, system.open_output_stream(posixpath.join(inside, f".{name}"))
                        yield pa.RecordBatch.from_arrays([pa.array([folder]), pa.array([name])], ["folder", "name"])
                    stream.write("".join(f"{line}\n" for line in batch.column(1).slice(begin, end - begin).to_pylist()).encode())
                    begin = end
        finally:
            if stream:
                stream.close()

    return lines.select("folder", "line").mapInArrow(write, "folder STRING, name STRING")


def publish_drafts(drafts: DataFrame) -> int:
    """Put the drafts (``folder``, ``names``) in the place of the files that their folders have; returns how many folders."""

    def publish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder, names in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                system, inside = file_system(folder)
                there = {posixpath.basename(one.path) for one in system.get_file_info(fs.FileSelector(inside))}
                for name in there:
                    if name not in names and not name.startswith("."):
                        system.delete_file(posixpath.join(inside, name))
                for name in names:
                    if f".{name}" in there:  # else a try before this one has moved it
                        system.move(posixpath.join(inside, f".{name}"), posixpath.join(inside, name))
            yield pa.RecordBatch.from_arrays([pa.array([len(batch)], pa.int64())], ["folders"])

    done = drafts.select("folder", "names").mapInArrow(publish, "folders BIGINT")
    return done.agg(F.coalesce(F.sum("folders"), F.lit(0))).first()[0]
