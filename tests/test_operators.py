"""Numbering, joins, name allocation, states, tails against brute force."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from jobtide import session
from jobtide.operators import jobs, logs, reaping, retry
from jobtide.operators.launch import label_map, merge_labels
from jobtide.operators.naming import allocate_names, slot_words
from jobtide.operators.numbering import number_rows, serial_slice
from jobtide.operators.skew import hot_keys, skew_join
from jobtide.plans import launches as launch_plans
from jobtide.sinks import files as sinks
from jobtide.sources import events as event_source
from jobtide.sources import logfiles
from jobtide.sources.events import read_events
from jobtide.streaming import launch as launches
from jobtide.streaming.tail import complete_lines, tail_once

SF = "/root/testdata/sf0.001"


def hot_rows(n=3000):
    rng = random.Random(5)
    return [("hot" if rng.random() < 0.4 else f"k{rng.randrange(300)}", i) for i in range(n)]


def test_numbers_within_keys(spark):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "k STRING, serial BIGINT").repartition(7)
    got = number_rows(df, ["k"], ["serial"], serial_slice("serial", 17), "n", first=1).collect()
    seen, want = {}, {}
    for k, serial in rows:
        seen[k] = seen.get(k, 0) + 1
        want[serial] = (k, seen[k])
    assert {r.serial: (r.k, r.n) for r in got} == want


@pytest.mark.parametrize("share", [0.01, 0.9])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_skew_join_is_an_ordinary_join(spark, how, share):
    rows = hot_rows() + [(None, 9999)]
    big = spark.createDataFrame(rows, "k STRING, serial BIGINT").repartition(5)
    small = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), ("none", 4), (None, 5)], "k STRING, v INT")
    got = sorted(map(str, skew_join(big, small, ["k"], how, hot_keys(big, ["k"], share)).collect()))
    assert got == sorted(map(str, big.join(small, "k", how).collect()))


def test_skew_join_refuses_unlike_keys(spark):
    small = spark.range(3).select(F.col("id").cast("int").alias("id"))
    with pytest.raises(ValueError, match="exact type"):
        skew_join(spark.range(9), small, ["id"])


def test_hot_keys_are_found(spark):
    big = spark.createDataFrame(hot_rows(), "k STRING, serial BIGINT").repartition(5)
    name = spark.createDataFrame([("hot",)], "k STRING").select(F.xxhash64("k")).first()[0]
    assert hot_keys(big, ["k"], 0.05) == [name]
    assert hot_keys(big, ["serial"], 0.01) == []
    assert hot_keys(big.where("false"), ["k"], 0.01) == []


def test_a_hot_key_is_dealt_out(spark):
    big = spark.range(20000).select(F.lit("hot").alias("k"), "id")
    small = spark.createDataFrame([("hot", 1)], "k STRING, v INT").hint("merge")
    joined = skew_join(big, small, ["k"], hot=hot_keys(big, ["k"]), spread=64)
    assert "SortMergeJoin" in joined._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = skew_join(big, small, ["k"], hot=hot_keys(big, ["k"]), spread=64).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(parts) == 4 and max(r["count"] for r in parts) < 12000


def sequential_names(requests, existing):
    """One request after the other; a name that is also a stem waits for its own request."""
    stems = {s for s, _ in requests}
    used, out = set(existing), {}
    for stem, serial in sorted(requests, key=lambda r: r[1]):
        out[serial] = None
        for k in range(1000):
            name = stem if k == 0 else f"{stem}-{k}"
            if name not in used and (k == 0 or name not in stems):
                used.add(name)
                out[serial] = name
                break
    return out


def test_allocated_names(spark):
    rng = random.Random(3)
    stems = ["a", "b", "a-2", "a-2-1", "c-1000", "c", "d-07", "d"]
    requests = [(rng.choice(stems), i) for i in range(400)] + [("full", i) for i in range(400, 410)]
    existing = ["a", "a-1", "a-5", "b-3", "c-1000", "d-07", "zzz"] + ["full"] + [f"full-{k}" for k in range(1, 995)]
    df = spark.createDataFrame(requests, "stem STRING, delivery_id BIGINT")
    names = spark.createDataFrame([(e,) for e in existing], "name STRING")
    got = {r.delivery_id: r.target_name for r in allocate_names(df, names, "delivery_id", slice_width=50).collect()}
    assert got == sequential_names(requests, existing)
    assert sum(v is None for v in got.values()) == 5
    taken = [v for v in got.values() if v]
    assert len(taken) == len(set(taken)) and not set(taken) & set(existing)


def test_names_carried_as_bitmaps(spark, tmp_path):
    """Batch after batch with the bitmaps of the batches before, one stem running out of names."""
    rng, table, used = random.Random(8), launches.slot_table(spark, str(tmp_path / "out"), fan=2, buckets=4), set()
    none = spark.createDataFrame([], "name STRING")
    for batch in range(7):
        stems = ["a", "a-2", "b", f"only-{batch}"]
        requests = [(rng.choice(stems), i) for i in range(40)] + [("hot", 100 + i) for i in range(170)]
        df = spark.createDataFrame(requests, "stem STRING, delivery_id BIGINT")
        given = table.lookup(df.select("stem"), "run", batch)
        known = [r.stem for r in given.collect()]
        assert len(known) == len(set(known)) and set(known) <= {s for s, _ in requests}
        got = allocate_names(df, none, "delivery_id", given=given).select("delivery_id", "target_name").collect()
        got = {r.delivery_id: r.target_name for r in got}
        assert got == sequential_names(requests, used)
        fresh = [n for n in got.values() if n]
        names = spark.createDataFrame([(n,) for n in fresh], "name STRING")
        for _ in range(1 + batch % 2):  # some batches run twice
            table.write(slot_words(names), "run", batch)
        used |= set(fresh)
    assert sum(n.startswith("hot") for n in used) == 1000 and "hot-999" in used


@pytest.mark.parametrize("query", ["metadata_files", "outcome_union", "repeated_job_names"])
def test_requests_are_not_broadcast_for_their_names(spark, monkeypatch, query):
    """What the optimizer takes requests for says nothing about their number, so they go to their names by a shuffle."""
    plans, write = [], launch_plans.write_metadata

    def seen(plan, path, run):
        plans.append(plan.select("metadata_path", "inmeta", "routename"))
        write(plan, path, run)

    monkeypatch.setattr(launch_plans, "write_metadata", seen)
    plans.append(getattr(launch_plans, query)(spark, SF))
    joins = [x for x in plans[0]._jdf.queryExecution().sparkPlan().toString().splitlines() if "Join" in x and "__digest" in x]
    assert joins and all("SortMergeJoin" in x for x in joins)


def test_more_requests_than_names(spark):
    df = spark.range(1200).select(F.lit("s").alias("stem"), F.col("id").alias("delivery_id"))
    none = spark.createDataFrame([], "name STRING")
    got = allocate_names(df, none, "delivery_id", slice_width=100).collect()
    assert len(got) == 1200
    assert {r.delivery_id for r in got if r.target_name is None} == set(range(1000, 1200))
    assert next(r.target_name for r in got if r.delivery_id == 999) == "s-999"


def test_labels_overlay(spark):
    base = F.create_map(F.lit("app"), F.lit("x"), F.lit("k"), F.lit("template"))
    own = label_map({"k": F.lit("request")})
    row = spark.range(1).select(merge_labels(base, own).alias("m")).first()
    assert row.m == {"app": "x", "k": "request"}


def test_retry_schedule(spark):
    df = spark.range(12).select(F.lit("m").alias("uid"), "id")
    got = retry.retry_schedule(df, ["uid"], "id", slice_width=5).orderBy("attempt").collect()
    assert [r.attempt for r in got] == list(range(1, 13))
    assert [r.publish_delay for r in got[:9]] == [5 * n for n in range(1, 10)] and got[9].publish_delay is None
    assert got[3].connect_delay == 8 and got[3].waited_before == 5 + 10 + 15
    assert [r.exhausted for r in got] == [False] * 9 + [True] * 3


def job_event(version, uid="u", name="cds-a", kind="Job", change="MODIFIED", **counters):
    status = {"active": None, "failed": None, "succeeded": None, "startTime": None, "conditions": None, **counters}
    return (change, (kind, (uid, name, "ns", str(version)), tuple(status[c] for c in ("active", "failed", "succeeded", "startTime", "conditions"))))


def read(spark, rows):
    return event_source.flatten_events(spark.createDataFrame(rows, event_source.WATCH_SCHEMA))


def test_status_messages_of_events(spark):
    now = dt.datetime(2021, 5, 1)
    splat = [("Failed", "True", now, "it hit the ground falling", "it went splat")]
    rows = [
        job_event(1, active=0, succeeded=1),
        job_event(2, active=0, failed=1, startTime=now, conditions=splat),
        job_event(3, active=0, failed=1, startTime=now, conditions=[]),
        job_event(4, name="backup-a", active=1),
        job_event(5, kind="Status", active=1),
        job_event(6, change="DELETED", active=1),
        job_event(7, active=0),
    ]
    got = jobs.status_messages(jobs.classify_jobs(read(spark, rows))).orderBy("resource_version").collect()
    assert [(r.resource_version, r.routing_key) for r in got] == [
        (1, "cds.job.success"), (2, "cds.job.failed"), (3, "cds.job.failed"), (7, "cds.job.None"),
    ]
    assert got[0].body == '{"job-id":"u","job-name":"cds-a","job-namespace":"ns","retry-count":0}'
    assert got[1].body.endswith('"retry-count":1,"failure-reason":"it hit the ground falling - it went splat"}')
    assert got[2].failure_reason == "Unknown"


def test_cursor_and_gap(spark):
    events = read(spark, [job_event(v) for v in (10, 11, 14)])
    assert jobs.after_cursor(events, 11).count() == 1
    assert jobs.after_cursor(events, None).count() == 0
    cursors = spark.createDataFrame([("ns", 8)], "namespace STRING, cursor BIGINT")
    row = jobs.find_gap(events, cursors).first()
    assert (row.gap, row.resume_at) == (True, 14)
    row = jobs.find_gap(events, spark.createDataFrame([("ns", 9)], cursors.schema)).first()
    assert (row.gap, row.resume_at) == (False, 9)


def test_cursor_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "events")
    spark.range(10).withColumnRenamed("id", "resource_version").write.parquet(path)
    plan = jobs.after_cursor(spark.read.parquet(path), 4)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(resource_version,4)" in plan


def test_journal_and_states(spark, tmp_path):
    root = str(tmp_path / "journal")
    sinks.record_position(spark, root, 1, 123456)
    assert sinks.last_position(spark, root).first().position == 123456
    sinks.record_position(spark, root, 2, None)
    assert sinks.last_position(spark, root).first().position is None

    table = str(tmp_path / "states")
    schema = "uid STRING, resource_version BIGINT, name STRING, status STRING, deleted BOOLEAN"
    first = spark.createDataFrame([("a", 1, "n", "running", False), ("b", 2, "n", "running", False)], schema)
    second = spark.createDataFrame([("a", 5, "n", "success", False), ("b", 6, "n", None, True)], schema)
    late = spark.createDataFrame([("a", 3, "n", "retry", False)], schema)
    for batch, rows in enumerate((first, second, second, late)):
        sinks.append_states(rows, table, "one", min(batch, 2))
    # batch 2 was replaced by the late one, whose older entry does not win
    assert [tuple(r) for r in sinks.read_states(spark, table).collect()] == [("a", 5, "n", "success")]
    sinks.append_states(second, table, "one", 1)
    assert [tuple(r) for r in sinks.read_states(spark, table).collect()] == [("a", 5, "n", "success")]
    sinks.compact_states(spark, table, str(tmp_path / "compact"))
    compact = str(tmp_path / "compact")
    assert sinks.read_states(spark, compact).count() == 1
    # neither a new run nor an older change that comes late brings the deleted job back
    sinks.append_states(first, compact, "two", 0)
    assert [tuple(r) for r in sinks.read_states(spark, compact).collect()] == [("a", 5, "n", "success")]


def test_a_lost_position_is_cleared(spark, tmp_path):
    root = str(tmp_path / "journal")
    events = read(spark, [job_event(v) for v in (10, 11, 14)])
    for entry, (written, position, left) in enumerate([(9, 9, 9), (12, 12, 12), (5, 14, None)]):
        sinks.record_position(spark, root, 10 * entry, written)
        assert sinks.recover_position(spark, root, events, 10 * entry + 1) == position
        assert sinks.last_position(spark, root).first().position == left


def test_malformed_events_are_counted(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"type":"ADDED","object":{"kind":"Job","metadata":{"name":"cds-1","uid":"u"}}}\n{cut off\n[1]\n"x"\n{}\n')
    events = read_events(spark, str(tmp_path))
    assert events.count() == 5
    reasons = sorted((r.why or "processed", r.broken_line is not None) for r in events.select(jobs.skip_reason().alias("why"), "broken_line").collect())
    assert reasons[-1] == ("processed", False) and [r[0] for r in reasons[:-1]] == ["malformed"] * 4
    assert jobs.watched_events(events).count() == 1


def test_pod_logs_are_replaced(spark, tmp_path):
    schema = "job_name STRING, pod_name STRING, line_no BIGINT, line STRING"
    for text in ("first", "second"):
        sinks.write_pod_logs(spark.createDataFrame([("j", "p", 0, text)], schema), str(tmp_path / "logs"))
    sinks.write_pod_logs(spark.createDataFrame([("j", "q", 0, "other")], schema), str(tmp_path / "logs"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "logs")).collect()) == ["other", "second"]


def test_pod_logs_of_odd_names(spark, tmp_path, monkeypatch):
    schema = "job_name STRING, pod_name STRING, line_no BIGINT, line STRING"
    names = ["a=b/c", "100% +x", "q?*[z]^{", "tab\there", "é:\"'#\\", "", None, "plain"]
    rows = [("j", name, n, f"{n} of {name}" if n else None) for name in names for n in range(3)]
    base = str(tmp_path / "logs")
    frame = spark.createDataFrame(rows, schema)
    sinks.write_pod_logs(frame, base)
    # the folders are Spark's own, and nothing is left over by a second run of fewer tasks
    frame.select("job_name", "pod_name", "line").write.partitionBy("job_name", "pod_name").text(str(tmp_path / "spark"))
    folders = lambda root: sorted(p.name for p in (root / "job_name=j").iterdir())
    assert folders(tmp_path / "logs") == folders(tmp_path / "spark")
    sinks.write_pod_logs(frame.coalesce(1), base)
    back = sorted((r.job_name, r.pod_name or "", r.line) for r in logfiles.read_pod_logs(spark, base).collect())
    assert back == sorted((job, name or "", line or "") for job, name, _, line in rows)
    assert not [p for p in (tmp_path / "logs").rglob(".*")]


def test_pod_logs_are_put_in_place_by_tasks(spark, tmp_path, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter

    def refused(*_):
        raise AssertionError("one folder per pod, renamed by the driver")

    monkeypatch.setattr(DataFrameWriter, "partitionBy", refused)
    rows = spark.range(300).selectExpr("'j' AS job_name", "concat('p', id % 100) AS pod_name", "id AS line_no", "concat('line ', id) AS line")
    assert sinks.write_pod_logs(rows, str(tmp_path / "logs")) is True
    assert spark.read.text(str(tmp_path / "logs")).count() == 300


def test_long_messages_are_not_published(spark, tmp_path):
    rows = spark.createDataFrame([("k", "short"), ("k", "x" * 100)], "routing_key STRING, body STRING")
    sinks.publish(rows, str(tmp_path / "out"), "one", max_bytes=50)
    assert [r.value for r in spark.read.text(str(tmp_path / "out")).collect()] == ["short"]
    assert spark.read.parquet(str(tmp_path / "out-rejected")).first().reason == "body_too_long"


def test_numbers_of_sparse_serials_and_null_keys(spark):
    rng = random.Random(7)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(-(2**62), 2**62)) for _ in range(400)]
    got = number_rows(spark.createDataFrame(rows, "k STRING, v BIGINT"), ["k"], ["v"], serial_slice("v"), "n").collect()
    want = {(k, v): n for key in ("a", "b", None) for n, (k, v) in enumerate(sorted((r for r in rows if r[0] == key), key=lambda r: r[1]))}
    assert {(r.k, r.v): r.n for r in got} == want


def test_shared_folder_on_a_cluster(spark):
    class Cluster:
        class sparkContext:  # noqa: N801
            master = "spark://host:7077"

        class conf:  # noqa: N801
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(ValueError, match="share"):
        session.shared_dir(Cluster)


def test_reaping_needs_a_base_path(spark, tmp_path):
    message = "routing_key STRING, job_name STRING, job_namespace STRING"
    keys = ["success", "failed", "running", "retry", "success.late"]
    plan = reaping.plan_reaping(
        spark.createDataFrame([(f"cds.job.{k}", f"some-{k}", "ns") for k in keys], message), F.lit(False)
    )
    assert [r.action for r in plan.collect()] == ["archive+delete"] * 2 + ["none"] * 3
    pods = spark.createDataFrame([("ns", "some-success", "p1"), ("ns", "some-success", "p2"), ("ns", "some-running", "p3")],
                                 "job_namespace STRING, job_name STRING, pod_name STRING")
    lines = spark.createDataFrame([("ns", f"p{p}", n, f"line {n}") for p in (1, 2, 3) for n in range(50)],
                                  "job_namespace STRING, pod_name STRING, line_no BIGINT, line STRING")
    archived = reaping.archive_lines(plan, pods, lines)
    assert sinks.write_pod_logs(archived, None) is False
    assert sinks.write_pod_logs(archived, str(tmp_path / "pods")) is True
    folder = tmp_path / "pods" / "job_name=some-success" / "pod_name=p1"
    text = "".join(p.read_text() for p in sorted(folder.glob("part-*")))
    assert text == "".join(f"line {n}\n" for n in range(50))
    assert not (tmp_path / "pods" / "job_name=some-running").exists()


# --- logs ------------------------------------------------------------------------------------


@pytest.fixture
def log_base(tmp_path):
    rng = random.Random(1)
    base = tmp_path / "log base+1"
    contents = {}
    for route in ("alpha", "beta two", "podnames", ".hidden"):
        (base / route).mkdir(parents=True)
        for n in range(3):
            lines = ["w" * rng.randrange(60) + f" {i}" for i in range(rng.randrange(1, 900))]
            text = "\n".join(lines) + ("\n" if n % 2 else "")
            name = f"job-{n}.txt" if route == "podnames" else f"run {n}.log"
            (base / route / name).write_text(text)
            contents[route, name] = lines
    (base / "alpha" / "empty.log").write_text("")
    (base / "alpha" / "_marked.log").write_text("x\n")
    (base / "beta two" / ".dot").write_text("")
    return str(base), contents


def test_lines_across_many_splits(spark, log_base):
    base, contents = log_base
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = logfiles.read_lines(spark, base)
        got = {}
        for r in lines.collect():
            got.setdefault((r.route, r.log), {})[r.line_no] = r.line
        plan = lines._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = {k: dict(enumerate(v)) for k, v in contents.items() if not k[0].startswith(".")}
    assert got == want
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_listing(spark, log_base):
    base, contents = log_base
    files = logfiles.list_files(spark, base)
    sizes = {(r.route, r.log): r.size for r in files.collect()}
    for (route, name) in contents:
        if not route.startswith("."):
            assert sizes[route, name] == os.path.getsize(f"{base}/{route}/{name}")
    assert sizes["alpha", "empty.log"] == 0 and sizes["alpha", "_marked.log"] == 2 and sizes["beta two", ".dot"] == 0
    assert [r.route for r in logs.list_routes(files).orderBy("route").collect()] == ["alpha", "beta two", "podnames"]
    assert "podnames" not in [r.route for r in logs.list_routes(files, with_pointers=False).collect()]


def test_pointer_files(spark, log_base):
    base, contents = log_base
    got = {r.job_name: r.log_path for r in logfiles.read_pointers(spark, base).collect()}
    assert set(got) == {"job-0", "job-1", "job-2"}
    assert got["job-1"].split("\n")[:-1] == contents["podnames", "job-1.txt"]


def test_line_limit(spark):
    lines = ["a" * 32768, "a" * 32769, "a" * 32767 + "é", "€" * 20000, ""]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i INT, line STRING")
    got = logs.limit_lines(df).orderBy("i").collect()
    assert [r.over_limit for r in got] == [False, True, True, True, False]
    assert [len(r.shown) for r in got] == [32768, 32768, 32767, 32768 // 3, 0]
    assert [r.line for r in got] == lines


def test_split_lines_and_short_lines(spark):
    df = spark.createDataFrame([("a", "x\nlong\n\nlast\n"), ("b", ""), ("c", "one")], "k STRING, text STRING")
    lines = logs.split_lines(df, "text", ["k"])
    got = [(r.k, r.line_no, r.line) for r in lines.orderBy("k", "line_no").collect()]
    assert got == [("a", 0, "x"), ("a", 1, "long"), ("a", 2, ""), ("a", 3, "last"), ("c", 0, "one")]
    kept = logs.lines_from(lines, F.lit(0), skip_short=True)
    assert sorted(r.line for r in kept.collect()) == ["last", "long", "one"]


def test_tail_pages_hold_every_line(spark):
    lines = spark.range(2500).select(
        F.lit("r").alias("route"), F.lit("l").alias("log"), F.col("id").alias("line_no"),
        F.col("id").cast("string").alias("line"), F.current_timestamp().alias("last_modified"),
    )
    cursors = spark.createDataFrame([("r", "l", 990)], "route STRING, log STRING, next_line BIGINT")
    pages = logs.tail_pages(logs.new_lines(lines, cursors), 1000).orderBy("page").collect()
    assert [(p.from_line, p.lines, len(p.content)) for p in pages] == [(990, 10, 10), (1000, 1000, 1000), (2000, 500, 500)]
    assert [x for p in pages for x in p.content] == [str(i) for i in range(990, 2500)]


def test_growing_log(spark, tmp_path):
    base, root = tmp_path / "base", str(tmp_path / "state")
    (base / "r").mkdir(parents=True)
    log = base / "r" / "a.log"
    (base / "r" / "old.log").write_text("x\n")
    log.write_text("one\ntwo\n")
    os.utime(base / "r" / "old.log", (1_600_000_000, 1_600_000_000))

    def look(n):
        fresh = tail_once(spark, str(base), root, n)
        return sorted((r.log, r.line_no, r.line) for r in fresh.collect())

    assert look(0) == [("a.log", 0, "one"), ("a.log", 1, "two"), ("old.log", 0, "x")]
    with open(log, "a") as f:
        f.write("three\nfour\n")
    (base / "r" / "b.log").write_text("new\n")
    assert look(1) == [("a.log", 2, "three"), ("a.log", 3, "four"), ("b.log", 0, "new")]
    assert look(1) == [("a.log", 2, "three"), ("a.log", 3, "four"), ("b.log", 0, "new")]
    assert look(2) == []


def test_open_lines_and_late_files(spark, tmp_path):
    """An open line waits for its end, a file with an old time is read, a replaced one starts again."""
    base, root = tmp_path / "base", str(tmp_path / "state")
    (base / "r [x]").mkdir(parents=True)
    log, late, mark = (base / "r [x]" / n for n in ("a.log", "late*.log", "mark.log"))

    def look(n, **how):
        return sorted((r.log, r.line_no, r.line) for r in tail_once(spark, str(base), root, n, **how).collect())

    log.write_bytes("one\ntw".encode())
    assert look(0) == [("a.log", 0, "one")]
    assert look(1) == []
    late.write_text("old\nnews\n")
    os.utime(late, (1_000_000_000, 1_000_000_000))
    with open(log, "a") as f:
        f.write("o-rest\nthree\nop")
    assert look(2) == [("a.log", 1, "two-rest"), ("a.log", 2, "three"), ("late*.log", 0, "old"), ("late*.log", 1, "news")]
    assert look(2) == [("a.log", 1, "two-rest"), ("a.log", 2, "three"), ("late*.log", 0, "old"), ("late*.log", 1, "news")]
    mark.write_bytes(b"\xef\xbb\xbffirst\nsecond")
    late.write_text("new\n")
    assert look(3) == [("late*.log", 0, "new"), ("mark.log", 0, "first")]
    assert look(4, final=True) == [("a.log", 3, "op"), ("mark.log", 1, "second")]
    assert look(5, final=True) == [] == look(6)


@pytest.mark.parametrize(("text_bytes", "size", "kept"), [(10, 10, 3), (11, 10, 2), (15, 10, 1), (7, 10, 3), (8, 10, 2), (0, 0, 3)])
def test_lines_that_were_ended(spark, text_bytes, size, kept):
    value = complete_lines(F.lit(3), F.lit(text_bytes), F.lit(size), F.lit(False))
    assert spark.range(1).select(value.alias("v")).first().v == kept
