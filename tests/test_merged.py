"""Tables merged in levels, look-ups of last states and delayed redelivery, against plain Python."""

import os
import random

import pytest
from pyspark.sql import functions as F

from jobtide.sinks.merged import MergedTable
from jobtide.streaming import states

EVENT = "resource_version BIGINT, watch_type STRING, object_kind STRING, uid STRING, name STRING, namespace STRING, active INT, failed INT, succeeded INT, start_time TIMESTAMP"


@pytest.mark.parametrize("fan", [2, 3, 8])
def test_live_runs_cover_each_batch_once(spark, tmp_path, fan):
    table = MergedTable(spark, str(tmp_path), ["k"], {"n": ("BIGINT", "sum")}, fan=fan)
    for batches in range(300):
        live = list(table.live(batches))
        covered = sorted(n for level, first in live for n in range(first, first + fan**level))
        assert covered == list(range(batches))
        assert len(live) <= (fan - 1) * (1 + len(bin(batches)))


def table_of(spark, root, **sizes):
    return MergedTable(spark, root, ["k"], {"n": ("BIGINT", "sum"), "top": ("STRUCT<a: INT, b: STRING>", "max")}, **sizes)


def rows_of(df):
    return {r.k: (r.n, tuple(r.top)) for r in df.collect()}


def test_batches_are_merged(spark, tmp_path):
    root, rng, want, history = str(tmp_path / "t"), random.Random(2), {}, []
    table = table_of(spark, root, fan=3, buckets=4)
    for batch in range(11):
        rows = [(f"k{rng.randrange(12)}", rng.randrange(9), (rng.randrange(50), f"b{batch}")) for _ in range(rng.randrange(0, 9))]
        history.append(dict(want))
        df = spark.createDataFrame(rows, "k STRING, n BIGINT, top STRUCT<a: INT, b: STRING>")
        for _ in range(1 + batch % 2):  # some batches run twice
            keys = df.select("k")
            before = rows_of(table.lookup(keys, "r", batch))
            assert before == {k: v for k, v in history[batch].items() if k in {r[0] for r in rows}}
            table.write(df, "r", batch)
        for k, n, top in rows:
            old = want.get(k, (0, (-1, "")))
            want[k] = (old[0] + n, max(old[1], top))
    assert rows_of(table.read()) == want
    kept = sum(len(os.listdir(f"{root}/run=r/{level}")) for level in os.listdir(f"{root}/run=r"))
    assert kept <= 3 * 3 + 1


def test_other_streams_are_read_and_null_keys_count(spark, tmp_path):
    root = str(tmp_path / "t")
    table = table_of(spark, root, fan=2, buckets=3)
    for run, batches in (("a", 3), ("b", 2)):
        for batch in range(batches):
            rows = [("x", 1, (batch, run)), (None, 2, (0, run))]
            table.write(spark.createDataFrame(rows, "k STRING, n BIGINT, top STRUCT<a: INT, b: STRING>"), run, batch)
    assert rows_of(table.read()) == {"x": (5, (2, "a")), None: (10, (0, "b"))}
    # before its first batch a new stream sees the others
    assert rows_of(table.lookup(spark.createDataFrame([("x",)], "k STRING"), "c", 0)) == {"x": (5, (2, "a"))}
    assert rows_of(table.read("b", 1)) == {"x": (4, (2, "a")), None: (8, (0, "b"))}


def events_of(rng, count):
    rows = []
    for version in range(count):
        kind = rng.choice(["ADDED", "MODIFIED", "MODIFIED", "DELETED"])
        user = rng.randrange(9)
        rows.append((version, kind, "Job", f"u{user}", f"cds-{user}", "ns", rng.choice([None, 1]), rng.choice([None, 0, 2]), rng.choice([None, 1]), None))
    return rows


def test_look_ups_over_many_batches(spark, tmp_path):
    rows = events_of(random.Random(7), 120)
    events = spark.createDataFrame(rows, EVENT)
    root = str(tmp_path / "out")
    for batch in range(8):
        part = events.where(f"resource_version >= {15 * batch} and resource_version < {15 * (batch + 1)}")
        for _ in range(1 + (batch == 5)):
            states.lookup_batch(part, batch, root, "run", fan=3, buckets=4)
    status = {r.resource_version: r.status for r in states.state_changes(events).collect()}
    last, want = {}, {}
    for version, kind, _, uid, *_ in rows:
        want[version] = last.get(uid)
        last[uid] = None if kind == "DELETED" else status[version]
    found = spark.read.parquet(f"{root}/{states.LOOKED_UP}").collect()
    assert {r.resource_version: r.last_status for r in found} == want and len(found) == len(rows)
    # a deleted job is gone, and an old change that comes late brings no other state
    states.lookup_batch(events.where("resource_version < 5"), 8, root, "run", fan=3, buckets=4)
    alive = {uid: (version, status[version]) for version, kind, _, uid, *_ in rows for newest in [max(v for v, _, _, u, *_ in rows if u == uid)] if version == newest and kind != "DELETED"}
    assert {r.uid: (r.resource_version, r.status) for r in states.read_last_states(spark, root, fan=3, buckets=4).collect()} == alive
    with pytest.raises(ValueError, match="has fan and buckets 3x4"):
        states.read_last_states(spark, root)


def test_the_stream_of_look_ups(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    rows = events_of(random.Random(3), 60)
    for part in range(3):
        spark.createDataFrame(rows[20 * part : 20 * (part + 1)], EVENT).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(source)
        states.run_lookup_stream(stream, str(tmp_path / "check"), root).awaitTermination()
    found = spark.read.parquet(f"{root}/{states.LOOKED_UP}")
    assert found.count() == 60 and found.select(F.countDistinct("batch")).first()[0] == 3


def test_messages_come_back_when_they_are_due(spark, tmp_path):
    from jobtide.operators import messages as mq
    from jobtide.plans import messages as plans
    from jobtide.sources.queue import stream_messages
    from jobtide.streaming import delayed, runner

    root, source, checkpoint = (str(tmp_path / n) for n in ("out", "in", "check"))

    def never(valid):
        return valid.withColumns({"disposition": F.lit(mq.REQUEUE), "reason": F.lit("never")})

    handler = mq.Handler("never", plans.JOBS, "cds.job.*", plans.STATUS_HANDLER.schema, never)
    given = plans.statuses(spark, "/root/testdata/sf0.001")
    given.write.parquet(source)
    given.where("false").write.parquet(f"{root}/{delayed.RELEASES}/start")
    seen, before = {}, -1
    for now in (0, 3, 5, 12, 14, 15, 16):
        for _ in range(1 + (now == 5)):  # a release that is done again hands nothing over twice
            delayed.release_due(spark, root, before, now)
        stream = stream_messages(spark, [source, f"{root}/{delayed.RELEASES}"])
        delayed.run_delayed_stream(stream, [handler], checkpoint, root, now, max_attempts=3).awaitTermination()
        before = now
        for row in spark.read.parquet(f"{root}/{runner.VERDICTS}").where("reason <> 'schema'").select("attempt").distinct().collect():
            seen.setdefault(row.attempt, now)
    assert seen == {1: 0, 2: 5, 3: 15}
    verdicts = spark.read.parquet(f"{root}/{runner.VERDICTS}").where("reason in ('never', 'attempts_exhausted')")
    counts = {r.attempt: r["count"] for r in verdicts.groupBy("attempt").count().collect()}
    assert counts[1] == counts[2] == counts[3] > 0
    assert {r.attempt for r in verdicts.where("disposition = 'dead_letter'").collect()} == {3}
