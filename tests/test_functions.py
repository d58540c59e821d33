"""Column expressions against literal expectations and independent rules in Python."""

import datetime as dt
import itertools
import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from jobtide.functions import names, status, text
from jobtide.functions.topics import topic_regex


def expected_status(active, failed, succeeded, started):
    if (active or 0) > 0:
        return "retry" if (failed or 0) > 0 else "running"
    if active is None and failed is None and succeeded is None and not started:
        return "starting"
    if (succeeded or 0) > 0:
        return "success"
    return "failed" if started else None


def test_status_truth_table(spark):
    counts = [None, 0, 1, 2]
    rows = list(itertools.product(counts, counts, counts, [True, False]))
    df = spark.createDataFrame(rows, "a INT, f INT, s INT, started BOOLEAN").withColumn(
        "t", F.when(F.col("started"), F.current_timestamp())
    )
    got = df.select(
        "a", "f", "s", "started", status.job_status(*[F.col(c) for c in "afst"]).alias("status")
    ).collect()
    assert len(got) == 128
    for r in got:
        assert r.status == expected_status(r.a, r.f, r.s, r.started), r


def test_routing_key(column):
    assert column(["running", None], status.routing_key) == ["cds.job.running", "cds.job.None"]


CONDITION = "ARRAY<STRUCT<last_probe_time: TIMESTAMP, reason: STRING, message: STRING>>"


def test_failure_reason(column):
    def at(month):
        return dt.datetime(2021, month, 1)

    five = [(at(m), f"number {m}", "x") for m in (5, 3, 1, 2, 4)]
    tie = [(at(1), "first", "x"), (at(1), "second", "y"), (None, "third", "z")]
    lists = [five, [], None, tie, [(None, "only", None)]]
    got = column(lists, status.failure_reason, CONDITION)
    assert got == ["number 5 - x", "Unknown", "Unknown", "first - x", "only - None"]


def clean(value):
    value = re.sub(r"\s+", "-", value)
    value = re.sub("[^A-Za-z0-9-]", "", value).lower()[:59]
    return re.sub("^[^a-z0-9]+", "", re.sub("[^a-z0-9]+$", "", value))


NAMES = [
    ("! Read this, because it's very important! ", "read-this-because-its-very-important"),
    ("! Read this again, time 2.  ", "read-this-again-time-2"),
    (
        "this is a very long test name which is not going to get th in its entirety, because it is really too long",
        "this-is-a-very-long-test-name-which-is-not-going-to-get-th",
    ),
    ("no break wide\x1cspace", "no-break-wide-space"),
    ("élève École", "lve-cole"),
    ("...", ""),
    ("", ""),
    ("a ! b", "a--b"),
    ("!" * 100000 + "late" + "?" * 100000, "late"),
]


def test_clean_name(column):
    assert column([n for n, _ in NAMES], names.clean_name) == [want for _, want in NAMES]
    assert [clean(n) for n, _ in NAMES] == [want for _, want in NAMES]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("aZ09- \t ._!")), max_size=200), min_size=20, max_size=40))
def test_clean_name_any_text(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, v STRING")
    got = df.orderBy("i").select(names.clean_name(F.col("v"))).collect()
    assert [r[0] for r in got] == [clean(v) for v in values]


def test_job_name_keeps_its_suffix(spark):
    hints = ["test.mxf", "x" * 50, "x" * 51, "y " * 60, "-"]
    df = spark.createDataFrame([(i, h) for i, h in enumerate(hints)], "i INT, h STRING").orderBy("i")
    kept = names.kept_characters(F.col("h"))
    got = [r[0] for r in df.select(names.job_name(kept, F.lit("A1b2"))).collect()]
    plain = [r[0] for r in df.select(names.job_name(kept, F.lit("A1b2"), keep_suffix=False)).collect()]
    assert got[0] == plain[0] == "cds-testmxf-a1b2"
    assert got[1] == plain[1] == "cds-" + "x" * 50 + "-a1b2"
    for name in got:
        assert name.endswith("-a1b2") and len(name) <= 59
    assert plain[2] == ("cds-" + "x" * 51 + "-a1b2")[:59]


def test_safe_label(column):
    def label(value):
        kept = re.sub(r"[^A-Za-z0-9\-_.]", "", value)
        return kept if len(kept) < 63 else kept[:60] + "..."

    values = ["VX-12_3.mxf", "a b/c", "l" * 62, "l" * 63, "l" * 64, "é" * 90 + "z", "", "k\n" * 500]
    assert column(values, names.safe_label) == [label(v) for v in values]


def test_hint_order(spark):
    rows = [("f", "o", None, None), ("", "o", None, None), (None, None, "n", "a"), (None, None, None, "a"), (None,) * 4]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i INT, a STRING, b STRING, c STRING, d STRING")
    hint = names.name_hint(F.lit("token"), *[F.col(c) for c in "abcd"])
    assert [r[0] for r in df.orderBy("i").select(hint).collect()] == ["f", "", "n", "a", "token"]


def test_tokens_repeat_and_differ(column):
    first = column(["a", "b", None], lambda c: names.token(10, names.digest(c)))
    assert first == column(["a", "b", None], lambda c: names.token(10, names.digest(c)))
    assert len(set(first)) == 3 and all(re.fullmatch("[a-z0-9]{10}", t) for t in first)
    # all digits and letters are used: four of them make far more than 65,536 tokens
    many = column([str(i) for i in range(3000)], lambda c: names.token(4, names.digest(c)))
    assert len(set("".join(many))) == 36 and len(set(many)) > 2980


def test_queue_name_and_platform(column):
    assert column(["deliverables.syndication.*.upload"], lambda c: names.queue_name(c, "q-")) == [
        "q-deliverablessyndicationupload"
    ]
    keys = ["deliverables.syndication.test.upload", "deliverables.other.x", "deliverables.syndication.a.b.upload"]
    assert column(keys, names.platform) == ["test", None, None]


def test_flags(column):
    values = [None, "false", "No", "TRUE", "yes"]
    assert column(values, text.parse_flag) == [False, False, False, True, True]
    with pytest.raises(Exception, match="yes/no"):
        column(["maybe"], text.parse_flag)


def test_positions(column):
    values = ["123456", None, "abcde", "12.5", " 7 ", "-3", "", "9" * 30]
    assert column(values, text.parse_position) == [123456, None, None, None, 7, -3, None, None]


def test_sizes(column):
    k = 1024
    cases = {
        0: "0 bytes", 123: "123 bytes", 1000: "1000 bytes", 1023: "1020 bytes", k: "1024 bytes",
        k + 1: "1 Kb", 1500: "1.46 Kb", 123 * k: "123 Kb", k * k: "1024 Kb", k * k + 1: "1 Mb",
        123 * k**2: "123 Mb", 15 * k**3 // 2: "7.5 Gb", 3 * k**4: "3 Tb", 2000 * k**4: "2000 Tb",
        1152: "1.13 Kb",
    }
    assert column(list(cases), text.size_text, "BIGINT") == list(cases.values())


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_iso_offset_in_any_session_zone(spark, zone):
    seconds = [1704067200, 1719835200, 1719835200.25, 1711846800]
    want = [
        "2024-01-01T00:00:00Z", "2024-07-01T13:00:00+01:00", "2024-07-01T13:00:00.25+01:00", "2024-03-31T02:00:00+01:00",
    ]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(i, float(s)) for i, s in enumerate(seconds)], "i INT, s DOUBLE").orderBy("i")
        moment = F.timestamp_micros((F.col("s") * 1000000).cast("bigint"))
        got = df.select(text.iso_offset(moment), text.iso_offset(moment, "America/New_York", True)).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [r[0] for r in got] == want
    assert got[0][1] == "2023-12-31T19:00:00-05:00[America/New_York]"


def test_log_links(column):
    values = [
        "/var/log/cds_backend/route/a.log\n", " /var/log/cds_backend/x/var/log/cds_backend/ y\t", "/elsewhere/a.log", "a b",
    ]
    assert column(values, text.log_link) == ["/log/route/a.log", "/log/x/log/y", "/elsewhere/a.log", "a b"]


def test_paths_in_base(column):
    values = ["/base/a", "/base/../etc", "/base/x/../y", "/based/a", "/base", "/base/./a/../../b", None]
    assert column(values, lambda c: text.in_base(c, "/base/")) == [True, False, True, False, True, False, None]


def topic_fits(pattern, words):
    if not pattern:
        return not words
    if pattern[0] == "#":
        return topic_fits(pattern[1:], words) or (bool(words) and topic_fits(pattern, words[1:]))
    return bool(words) and pattern[0] in ("*", words[0]) and topic_fits(pattern[1:], words[1:])


@settings(max_examples=400, deadline=None)
@given(
    st.lists(st.sampled_from(["a", "b-c", "*", "#"]), min_size=1, max_size=5),
    st.lists(st.sampled_from(["a", "b-c", "x"]), min_size=0, max_size=5),
)
def test_topic_patterns(pattern, words):
    got = re.search(topic_regex(".".join(pattern)), ".".join(words)) is not None
    assert got == topic_fits(pattern, words)


def test_topic_examples():
    assert re.search(topic_regex("cds.job.*"), "cds.job.failed")
    assert not re.search(topic_regex("cds.job.*"), "cds.job.failed.again")
    assert not re.search(topic_regex("cds.job.*"), "cds-job.failed")
