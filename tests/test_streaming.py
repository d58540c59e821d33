"""Streams against their batch twins, stopped and started, and batches run twice."""

import pytest
from pyspark.sql import functions as F

from jobtide.operators import jobs, messages as mq
from jobtide.plans import events as event_plans
from jobtide.plans import messages as message_plans
from jobtide.plans.adapters import view
from jobtide.sinks.files import read_states
from jobtide.sources.events import read_events, stream_deduplicated, stream_events
from jobtide.sources.queue import read_messages, stream_messages
from jobtide.streaming import launch as launches, runner, status

SF = "/root/testdata/sf0.001"


def watch_rows(spark):
    meta = F.struct("uid", "name", "namespace", F.col("resource_version").cast("string").alias("resourceVersion"))
    counters = F.struct("active", "failed", "succeeded", F.col("start_time").alias("startTime"))
    return view(spark, SF, "job_events").select(
        "event_id", F.col("watch_type").alias("type"),
        F.struct(F.col("object_kind").alias("kind"), meta.alias("metadata"), counters.alias("status")).alias("object"),
    )


def messages_of(df):
    return sorted(tuple(r) for r in df.select("routing_key", F.col("body")).collect())


def test_stop_and_start(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    rows = watch_rows(spark)
    for part in ("event_id < 400", "event_id >= 400"):
        rows.where(part).drop("event_id").write.mode("append").json(source)
        stream = stream_events(spark, source)
        status.run_status_stream(stream, checkpoint, out).awaitTermination()
    got = spark.read.text(out).withColumnRenamed("value", "body")
    want = jobs.status_messages(jobs.classify_jobs(read_events(spark, source)))
    assert messages_of(got) == messages_of(want)
    assert read_events(spark, source).count() == view(spark, SF, "job_events").count()


def test_redelivery_within_the_delay_is_dropped(spark, tmp_path):
    source = str(tmp_path / "in")
    rows = watch_rows(spark).drop("event_id")
    rows.write.json(source)
    rows.write.mode("append").json(source)
    stream = stream_deduplicated(stream_events(spark, source, max_files=1))
    query = (
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == rows.count()


def test_states_of_a_replayed_stream(spark, tmp_path):
    source = str(tmp_path / "in")
    watch_rows(spark).drop("event_id").repartition(3).write.json(source)
    found = []
    for n in range(2):
        root = str(tmp_path / f"states{n}")
        stream = stream_events(spark, source, max_files=1 + 2 * n)
        status.run_state_stream(stream, str(tmp_path / f"check{n}"), root).awaitTermination()
        found.append(sorted(tuple(r) for r in read_states(spark, root).collect()))
    assert found[0] == found[1] and found[0]


@pytest.fixture
def stored(spark, tmp_path):
    folder = str(tmp_path / "messages")
    message_plans.deliveries(spark, SF).write.parquet(folder)
    return folder


HANDLERS = [message_plans.UPLOAD_HANDLER, message_plans.STATUS_HANDLER]


def test_a_batch_run_twice_leaves_its_results_once(spark, tmp_path, stored):
    root = str(tmp_path / "out")
    batch = read_messages(spark, stored)
    for _ in range(2):
        runner.write_batch(batch, 0, HANDLERS, root)
    counts = {
        folder: spark.read.schema("body BINARY").parquet(f"{root}/{folder}").count()
        for folder in (runner.VERDICTS, runner.DEAD_LETTERS, runner.RETRY, runner.UNROUTED)
    }
    done = mq.process(batch, HANDLERS)
    totals = {r.disposition: r.messages for r in runner.conserved(done).collect()}
    assert counts[runner.VERDICTS] == batch.count() == sum(totals.values())
    assert counts[runner.DEAD_LETTERS] == totals["dead_letter"]
    assert counts[runner.UNROUTED] == totals["unrouted"]
    assert counts[runner.RETRY] == 0


def test_stream_agrees_with_batch(spark, tmp_path, stored):
    root = str(tmp_path / "out")
    stream = stream_messages(spark, [stored])
    runner.run_stream(stream, HANDLERS, str(tmp_path / "check"), root).awaitTermination()
    columns = ["delivery_id", "handler", "disposition", "reason"]
    got = spark.read.parquet(f"{root}/{runner.VERDICTS}").select(columns)
    want = mq.process(read_messages(spark, stored), HANDLERS).select(columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    # what is rejected keeps its body as it came
    dead = spark.read.parquet(f"{root}/{runner.DEAD_LETTERS}").select("exchange", "delivery_id", "body")
    lost = dead.exceptAll(read_messages(spark, stored).select("exchange", "delivery_id", "body"))
    assert lost.count() == 0


def test_event_query_plan_has_one_shuffle_before_the_count(spark):
    df = event_plans.count_by_key(jobs.classify_jobs(event_plans._events(spark, SF)))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 2
    assert "ReadSchema: struct<event_id:bigint,ts:" in plan and "props" not in plan


def read_all(spark, root, folder, schema="delivery_id BIGINT"):
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(f"{root}/{folder}")


def test_launch_batches_share_no_names(spark, tmp_path):
    root = str(tmp_path / "out")
    requests = message_plans.uploads(spark, SF)
    middle = requests.agg(F.percentile_approx("delivery_id", 0.5)).first()[0]
    halves = [requests.where(F.col("delivery_id") <= middle), requests.where(F.col("delivery_id") > middle)]
    # the second batch fails and runs again, the first one is repeated late
    for number in (0, 1, 1, 0):
        launches.launch_batch(halves[number], number, message_plans.UPLOAD_HANDLER, root, "/meta", "ns", "run")
    plans = read_all(spark, root, launches.PLANS, "delivery_id BIGINT, job_name STRING, metadata_path STRING").collect()
    assert len(plans) == len({r.job_name for r in plans}) == len({r.metadata_path for r in plans}) == len({r.delivery_id for r in plans})
    assert read_all(spark, root, runner.VERDICTS).count() == requests.count()
    files = spark.read.parquet(f"{root}/{launches.METADATA}")
    assert sorted(r.metadata_path for r in files.collect()) == sorted(r.metadata_path for r in plans)
    # another run goes on from these names
    launches.launch_batch(halves[0], 0, message_plans.UPLOAD_HANDLER, root, "/meta", "ns", "other")
    again = read_all(spark, root, launches.PLANS, "job_name STRING, metadata_path STRING").collect()
    assert len(again) > len(plans) and len(again) == len({r.metadata_path for r in again}) == len({r.job_name for r in again})


def test_a_new_checkpoint_replaces_nothing(spark, tmp_path, stored):
    root = str(tmp_path / "out")
    for n in range(2):
        stream = stream_messages(spark, [stored])
        runner.run_stream(stream, HANDLERS, str(tmp_path / f"check{n}"), root).awaitTermination()
    verdicts = spark.read.parquet(f"{root}/{runner.VERDICTS}")
    assert verdicts.count() == 2 * read_messages(spark, stored).count()
    assert verdicts.select("run").distinct().count() == 2


def test_a_failed_batch_leaves_nothing_cached(spark, tmp_path, stored):
    def fail(valid):
        return valid.withColumn("outcome_key", F.raise_error(F.lit("handler failed")))

    broken = mq.Handler("broken", message_plans.JOBS, "cds.job.*", message_plans.STATUS_HANDLER.schema, fail)
    with pytest.raises(Exception, match="handler failed"):
        runner.write_batch(read_messages(spark, stored), 0, [broken], str(tmp_path / "out"))
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_a_launch_batch_holds_its_tables_in_files(spark, tmp_path, monkeypatch):
    """While a batch runs executors cache none of its rows, and a batch that fails leaves none of its tables."""
    root, held = tmp_path / "out", tmp_path / "out" / "held"
    seen = []

    def fail(batch, batch_id, handler, root, run, checked, planned):
        files = [p for p in held.rglob("*.parquet") if p.stat().st_size]
        seen.append((spark.sparkContext._jsc.getPersistentRDDs().size(), len(files) > 1, checked.count() >= planned.count() > 0))
        raise RuntimeError("disk is full")

    monkeypatch.setattr(launches, "_write_launches", fail)
    with pytest.raises(RuntimeError, match="disk is full"):
        launches.launch_batch(message_plans.uploads(spark, SF), 0, message_plans.UPLOAD_HANDLER, str(root), "/meta", "ns", "run")
    assert seen == [(0, True, True)] and not list(held.rglob("*.parquet"))


def test_a_stream_that_keeps_running(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = watch_rows(spark)
    rows.where("event_id < 300").drop("event_id").write.json(source)
    query = status.run_status_stream(stream_events(spark, source), str(tmp_path / "check"), out, {"processingTime": "1 second"})
    try:
        query.processAllAvailable()
        rows.where("event_id >= 300").drop("event_id").write.mode("append").json(source)
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    want = jobs.status_messages(jobs.classify_jobs(read_events(spark, source)))
    assert messages_of(spark.read.text(out).withColumnRenamed("value", "body")) == messages_of(want)


def test_batches_of_few_files_are_dealt_out(spark, tmp_path, monkeypatch):
    from jobtide.operators import messages as mq
    from jobtide.plans import messages as plans
    from jobtide.sources.queue import stream_messages
    from jobtide.streaming import runner

    monkeypatch.setattr(runner.dealt_out, "__defaults__", (20_000,))
    widest = []
    process = runner.process

    def seen(batch, handlers, hold):
        widest.append([r.rows for r in batch.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("rows")).collect()])
        return process(batch, handlers, hold)

    monkeypatch.setattr(runner, "process", seen)
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    plans.statuses(spark, "/root/testdata/sf0.001").coalesce(1).write.parquet(source)
    runner.run_stream(stream_messages(spark, [source]), [plans.STATUS_HANDLER], str(tmp_path / "check"), root).awaitTermination()
    rows = spark.read.parquet(source).count()
    assert sum(widest[0]) == rows == spark.read.parquet(f"{root}/{runner.VERDICTS}").count()
    assert max(widest[0]) < rows / 8
