"""Files listed, read by ranges and indexed, against plain Python."""

import bz2
import gzip
import io
import os
import random
import time
import zlib

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from jobtide.sinks.files import write_pointers
from jobtide.sources import lineindex, logfiles, ranges
from jobtide.streaming.tail import run_tail, tail_once


def plain_lines(data, opened=True):
    lines = data.removeprefix(b"\xef\xbb\xbf").split(b"\n")
    last = lines.pop()
    return lines + ([last] if last and opened else [])


CONTENT = st.lists(st.sampled_from([b"", b"a", b"bc", b"\n", b"\n\n", b"\r\n", b"x" * 7, "é€".encode(), b"\xef\xbb\xbf"]), max_size=30).map(b"".join)


@settings(max_examples=400, deadline=None)
@given(CONTENT, st.integers(1, 9), st.booleans(), st.integers(1, 5))
def test_ranges_hold_every_line_once(data, width, opened, piece):
    before = ranges._PIECE
    ranges._PIECE = piece
    try:
        found = []
        for begin in range(0, len(data), width):
            found += ranges._lines_of(io.BytesIO(data), begin, min(len(data), begin + width), len(data), False, opened)
    finally:
        ranges._PIECE = before
    # a mark longer than the first piece that is read stays
    want = plain_lines(data, opened)
    if piece >= 3 or not data.startswith(b"\xef\xbb\xbf"):
        assert [line for line, _ in found] == want
    assert all(data[:behind].endswith(b"\n") or behind == len(data) for _, behind in found)


def test_a_file_that_shrinks_meanwhile_ends():
    assert [line for line, _ in ranges._lines_of(io.BytesIO(b"a\nb"), 0, 100, 100, True, False)] == [b"a"]


@pytest.fixture
def folder(tmp_path):
    rng = random.Random(4)
    base = tmp_path / "lo gs"
    contents = {}
    for route in ("r1", "r2", ".hidden", "e%20+ü"):
        for log in ("a.log", "_x", ".x", "sub/deep.log", "empty"):
            data = b"" if log == "empty" else b"".join(rng.choice([b"line", b"", b"\n", b"long " * 9, "ü\n".encode()]) for _ in range(rng.randrange(400)))
            path = base / route / log
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_bytes(data)
            contents[route, log] = data
    (base / "r1" / ".a.log.crc").write_bytes(b"no log")
    (base / "top.log").write_bytes(b"in no route\n")
    return base, contents


def all_of(df):
    return sorted((r.route, r.log, r.line_no, r.line) for r in df.collect())


def wanted_lines(contents, choose=lambda route, log, n: True):
    return sorted(
        (route, log, n, line.decode()) for (route, log), data in contents.items() for n, line in enumerate(plain_lines(data)) if choose(route, log, n)
    )


def test_listing(spark, folder):
    base, contents = folder
    for start in (str(base), f"file:{base}", f"file://{base}/"):
        found = {(r.route, r.log): (r.size, r.last_modified.timestamp()) for r in logfiles.list_files(spark, start).collect()}
        assert {name: size for name, (size, _) in found.items()} == {name: len(data) for name, data in contents.items()}
        times = {name: os.stat(base / name[0] / name[1]).st_mtime for name in contents}
        assert all(abs(found[name][1] - times[name]) < 0.002 for name in contents)


@pytest.mark.parametrize("width", [7, 100, 1 << 20])
def test_index_of_a_folder(spark, folder, tmp_path, width):
    base, contents = folder
    root = str(tmp_path / "index")
    index = lineindex.refresh_index(spark, str(base), root, 0, width=width)
    assert all_of(lineindex.all_lines(index)) == wanted_lines(contents)
    wanted = spark.createDataFrame([("r1", "a.log", 3, 9), ("r2", "_x", 5, None), (".hidden", ".x", 0, 1)], "route STRING, log STRING, from_line BIGINT, until_line BIGINT")
    chosen = {("r1", "a.log"): range(3, 9), ("r2", "_x"): range(5, 10**6), (".hidden", ".x"): range(1)}
    assert all_of(lineindex.lines_between(index, wanted)) == wanted_lines(contents, lambda route, log, n: n in chosen.get((route, log), ()))


def test_unchanged_files_are_not_counted_again(spark, folder, tmp_path):
    base, contents = folder
    root, width = str(tmp_path / "index"), 50

    def counted(version, **how):
        index = lineindex.refresh_index(spark, str(base), root, version, width=width, **how)
        assert all_of(lineindex.all_lines(index)) == wanted_lines(contents)
        return index.where(F.col("counted_in") == version)

    assert counted(0).count() > 10
    assert counted(1).count() == 0
    # only the end of a file that grew is counted, and a file that went is forgotten
    path = base / "r1" / "a.log"
    with open(path, "ab") as file:
        file.write(b"more\nand more")
    contents["r1", "a.log"] = path.read_bytes()
    (base / "r2" / "a.log").unlink()
    old_size = len(contents["r1", "a.log"]) - 13
    del contents["r2", "a.log"]
    fresh = counted(2, append_only=True).collect()
    assert {(r.route, r.log) for r in fresh} == {("r1", "a.log")} and min(r.begin for r in fresh) == old_size // width * width
    # a file that may have been replaced is counted as a whole
    path.write_bytes(b"all\nnew\n" * 60)
    contents["r1", "a.log"] = path.read_bytes()
    assert min(r.begin for r in counted(3).collect()) == 0


def test_blocks_are_chosen_by_line(spark, tmp_path):
    (tmp_path / "logs" / "r").mkdir(parents=True)
    (tmp_path / "logs" / "r" / "a").write_bytes(b"".join(b"%05d\n" % n for n in range(10_000)))
    index = lineindex.refresh_index(spark, str(tmp_path / "logs"), str(tmp_path / "index"), 0, width=600)
    wanted = spark.createDataFrame([("r", "a", 5_000, 5_020)], "route STRING, log STRING, from_line BIGINT, until_line BIGINT")
    blocks = lineindex.blocks_of(index, wanted).collect()
    assert index.count() == 100 and sum(b.end - b.begin for b in blocks) == 600
    assert [r.line for r in lineindex.lines_between(index, wanted).orderBy("line_no").collect()] == [f"{n:05d}" for n in range(5_000, 5_020)]


@pytest.mark.parametrize("width", [5, 64 << 20])
def test_tail_reads_only_what_was_appended(spark, tmp_path, width):
    base, root = tmp_path / "base", str(tmp_path / "state")
    rng, contents, delivered = random.Random(width), {}, {}
    for look in range(4):
        appended = 0
        for route, log in (("r", "a.log"), ("r", "_x"), ("r", ".x"), ("s", "b.log")):
            if rng.random() < 0.8:
                more = b"".join(rng.choice([b"ab", b"\n", b"c\n", "ü".encode()]) for _ in range(rng.randrange(1, 40)))
                path = base / route / log
                path.parent.mkdir(parents=True, exist_ok=True)
                with open(path, "ab") as file:
                    file.write(more)
                contents[route, log] = contents.get((route, log), b"") + more
                appended += len(more)
        for r in tail_once(spark, str(base), root, look, width=width).collect():
            assert (r.route, r.log, r.line_no) not in delivered
            delivered[r.route, r.log, r.line_no] = r.line
        read = spark.read.parquet(f"{root}/ranges/look={look}").selectExpr("coalesce(sum(end - begin), 0)").first()[0]
        held = {name: len(data.rsplit(b"\n", 1)[-1]) for name, data in contents.items()}
        # what is appended, and open lines that were held back before
        assert read <= appended + 80 * len(held)
        assert delivered == {(*name, n): line.decode() for name, data in contents.items() for n, line in enumerate(plain_lines(data, opened=False))}
    # nothing new: nothing is read but open lines
    assert tail_once(spark, str(base), root, 4, width=width).count() == 0
    assert spark.read.parquet(f"{root}/ranges/look=4").count() == 0


def test_packed_logs(spark, tmp_path):
    base, root = tmp_path / "base", str(tmp_path / "state")
    (base / "r").mkdir(parents=True)
    data = b"\xef\xbb\xbfone\n\ntwo" + b"\nx" * 20_000
    packed = {"a.gz": gzip.compress(data), "b.bz2": bz2.compress(data), "c.deflate": zlib.compress(data), "_d.gz": gzip.compress(data)}
    for name, content in packed.items():
        (base / "r" / name).write_bytes(content)
    want = sorted((name, n, line.decode()) for name in packed for n, line in enumerate(plain_lines(data)))
    assert sorted((r.log, r.line_no, r.line) for r in tail_once(spark, str(base), root, 0).collect()) == want
    assert tail_once(spark, str(base), root, 1).count() == 0


def test_a_tail_that_keeps_running(spark, tmp_path):
    base, root = tmp_path / "base", str(tmp_path / "state")
    (base / "r").mkdir(parents=True)
    log = base / "r" / "a.log"
    log.write_text("one\n")
    for more in ("two\n", "three\n"):  # stopped and started again on the same checkpoint
        query = run_tail(spark, str(base), root, str(tmp_path / "check"), {"processingTime": "1 second"})
        try:
            until = time.time() + 40
            while not query.lastProgress and time.time() < until:
                time.sleep(0.2)
            with open(log, "a") as file:
                file.write(more)
            # two more looks at least
            before, until = query.lastProgress["batchId"], time.time() + 40
            while query.lastProgress["batchId"] < before + 2 and query.isActive and time.time() < until:
                time.sleep(0.2)
        finally:
            query.stop()
        assert query.exception() is None
    lines = spark.read.parquet(f"{root}/lines").orderBy("line_no").collect()
    assert [(r.line_no, r.line) for r in lines] == [(0, "one"), (1, "two"), (2, "three")]


def test_pointers_of_one_job_and_again(spark, tmp_path):
    base = str(tmp_path)
    rows = [("job a/1+ü", "/p/1"), ("job a/1+ü", "/p/3"), ("job a/1+ü", "/p/2"), ("other", None), (None, "/p")]
    first = spark.createDataFrame(rows, "job_name STRING, log_path STRING").repartition(3)
    assert write_pointers(first, base) == 2
    got = {r.job_name: r.log_path for r in logfiles.read_pointers(spark, base).collect()}
    assert got == {"job a/1+ü": "/p/3\n", "other": "\n"}
    assert write_pointers(spark.createDataFrame([("other", "/new")], "job_name STRING, log_path STRING"), base) == 1
    got = {r.job_name: r.log_path for r in logfiles.read_pointers(spark, base).collect()}
    assert got == {"job a/1+ü": "/p/3\n", "other": "/new\n"}
    assert write_pointers(first.where("false"), base) == 0


def test_a_folder_is_listed_entry_by_entry(tmp_path, monkeypatch):
    import pyarrow as pa

    def whole(*_, **__):
        raise AssertionError("the whole folder at once")

    (tmp_path / "below").mkdir()
    for n in range(20):
        (tmp_path / f"_{n}.log").write_text("x" * n)
    monkeypatch.setattr(ranges.fs, "FileSelector", whole)
    monkeypatch.setattr(ranges, "_ROWS", 8)
    folders = pa.RecordBatch.from_arrays([pa.array([str(tmp_path), str(tmp_path / "none")])], ["path"])
    parts = list(ranges._children(iter([folders])))
    assert [len(part) for part in parts] == [8, 8, 5]
    got = {row["path"]: (row["size"], row["is_folder"]) for part in parts for row in part.to_pylist()}
    assert got == {str(tmp_path / "below"): (0, True)} | {str(tmp_path / f"_{n}.log"): (n, False) for n in range(20)}
