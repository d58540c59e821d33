"""Schema check, routing, disposition and metadata on literal messages."""

import json

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from jobtide import fixed
from jobtide.operators import launch, messages as mq, metadata

SIMPLE = {
    "type": "object",
    "properties": {"id": {"type": "integer"}, "title": {"type": "string"}},
    "required": ["id", "title"],
}
MESSAGE = "exchange STRING, routing_key STRING, delivery_id BIGINT, body BINARY, attempt INT"


def check(spark, bodies, schema):
    df = spark.createDataFrame(
        [(i, b if isinstance(b, bytes) else b.encode()) for i, b in enumerate(bodies)], "i INT, body BINARY"
    )
    return mq.validate(df, schema).orderBy("i").collect()


BODIES = [
    ('{"id": 1, "title": "x"}', None),
    ('{"id": 1, "title": "x", "junk_field": [1, {"a": null}]}', None),
    ('{"title": "x"}', "missing:id"),
    ('{"id": 1.0, "title": "x"}', None),
    ('{"id": 1.5, "title": "x"}', "type:id"),
    ('{"id": true, "title": "x"}', "type:id"),
    ('{"id": null, "title": "x"}', "type:id"),
    ('{"id": 1e300, "title": "x"}', None),
    ('{"id": 123456789012345678901234567890, "title": "x"}', None),
    ('{"id": 1, "title": 7}', "type:title"),
    ('{"id": "a", "id": 2, "title": "x"}', None),
    ('{"id": 1, "title": "x"', "not_json"),
    ('{"id": 1, "title": "x"} trailing', "not_json"),
    ('{"id": 1, "title": "x"}{"a": 1}', "not_json"),
    ('{"id": 1, "title": "x"}, 7', "not_json"),
    ('{"id": 1, "title": "x"}] [1', "not_json"),
    ('  {"id": 1, "title": "x"}\n', None),
    ("[1]", "type:$"),
    ("null", "type:$"),
    ('"text"', "type:$"),
    ("", "not_json"),
    (b"\xff\xfe{}", "not_utf8"),
    ('{"id": 1, "title": "été"}', None),
]


def test_schema_check(spark):
    got = check(spark, [b for b, _ in BODIES], SIMPLE)
    assert [r.reason for r in got] == [want for _, want in BODIES]
    assert all((r.disposition == mq.ACK) == (r.reason is None) for r in got)
    assert got[0].id == 1 and got[0].title == "x" and got[10].id == 2


def test_integers_of_any_length(spark):
    texts = ["7", "7.0", "123456789012345678901234567890", "9007199254740993", "9007199254740993.5", "-12", "1" * 60]
    got = check(spark, [f'{{"id": {t}, "title": "x"}}' for t in texts], SIMPLE)
    assert [r.reason for r in got] == [None] * 4 + ["type:id"] + [None] * 2
    assert [str(r.id) for r in got[:4]] == ["7", "7", texts[2], texts[3]]
    assert [r.id_text for r in got[:4]] == ["7", "7", texts[2], texts[3]] and got[5].id_text == "-12"


def test_one_scan_for_many_handlers(spark, tmp_path):
    message_rows = [("x", f"a.{i % 3}", i, b'{"id": 1, "title": "t"}', 1) for i in range(9)]
    spark.createDataFrame(message_rows, mq.MESSAGE_SCHEMA).write.parquet(str(tmp_path / "m"))
    messages = spark.read.parquet(str(tmp_path / "m"))

    def told(name):
        fit = F.col("disposition") == mq.ACK
        return lambda df: df.withColumns({"outcome_key": F.when(fit, F.lit(name)), "outcome_body": F.when(fit, F.col("title"))})

    handlers = [mq.Handler(f"h{i}", "x", f"a.{i}", SIMPLE, told(f"k{i}"), sees_all=True) for i in range(3)]
    handlers += [mq.Handler(f"h{i}", "x", "a.*", SIMPLE) for i in range(3, 5)] + [mq.Handler("blind", "x", "a.1", None)]
    done = mq.process(messages, handlers)
    assert done._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    rows = done.collect()
    assert len(rows) == 9 * 3 + 3
    for r in rows:
        own = r.handler in ("h0", "h1", "h2")
        assert (r.outcome_key, r.outcome_body) == ((f"k{r.handler[1]}", "t") if own else (None, None))
        assert r.disposition == ("requeue" if r.handler == "blind" else "ack")


def test_null_and_absent_and_empty(spark):
    base = {"inmeta": "m", "routename": "r"}
    extra = [{}, {"filename": None}, {"filename": ""}, {"filename": "f"}, {"filename": 3}]
    got = check(spark, [json.dumps({**base, **e}) for e in extra], fixed.UPLOAD_SCHEMA)
    assert [r.reason for r in got] == [None] * 4 + ["type:filename"]
    assert [r.filename for r in got[:4]] == [None, None, "", "f"]


def test_unsupported_schema_is_refused():
    for schema in ({"type": "array"}, {"type": "object", "minProperties": 1},
                   {"type": "object", "properties": {"a": {"type": "string", "maxLength": 2}}},
                   {"type": "object", "properties": {"a": {"type": "decimal"}}}):
        with pytest.raises(ValueError):
            mq.MessageCheck.compile(schema)


def test_fields_with_dashes(spark):
    body = {"job-id": "u", "job-name": "n", "job-namespace": "ns", "retry-count": 2, "failure-reason": "r"}
    row = check(spark, [json.dumps(body)], fixed.STATUS_SCHEMA)[0]
    assert (row.job_id, row.job_name, row.job_namespace, row.retry_count, row.failure_reason) == ("u", "n", "ns", 2.0, "r")


def queue(spark, rows):
    return spark.createDataFrame([(e, k, i, b.encode(), 1) for i, (e, k, b) in enumerate(rows)], MESSAGE)


def test_each_message_is_accounted_for(spark):
    def reject_odd(valid):
        odd = F.col("id") % 2 == 1
        return valid.withColumns(
            {"disposition": F.when(odd, mq.REQUEUE).otherwise(mq.ACK), "reason": F.when(odd, "odd")}
        )

    rows = [
        ("a", "k.one", '{"id": 1, "title": "x"}'),
        ("a", "k.two", '{"id": 2, "title": "x"}'),
        ("a", "k.bad", "{"),
        ("a", "other", '{"id": 2, "title": "x"}'),
        ("b", "k.one", "anything"),
        ("c", "k.one", '{"id": 2, "title": "x"}'),
    ]
    handlers = [
        mq.Handler("h", "a", "k.*", SIMPLE, reject_odd),
        mq.Handler("blind", "b", "#", None),
    ]
    messages = queue(spark, rows)
    got = {r.delivery_id: r for r in mq.process(messages, handlers).collect()}
    assert len(got) == len(rows)
    assert [got[i].disposition for i in range(6)] == [
        "requeue", "ack", "dead_letter", "unrouted", "requeue", "unrouted",
    ]
    assert [got[i].reason for i in range(6)] == ["odd", None, "not_json", "no_binding", "no_schema", "no_binding"]
    assert [got[i].handler for i in range(6)] == ["h", "h", "h", None, "blind", None]


def test_two_queues_each_get_the_message(spark):
    bindings = [mq.Binding("x", "cds.job.*", "one"), mq.Binding("x", "cds.#", "two")]
    messages = queue(spark, [("x", "cds.job.failed", "{}"), ("x", "cds", "{}"), ("y", "cds.job.failed", "{}")])
    got = sorted((r.delivery_id, r.handler) for r in mq.route(messages, bindings).collect())
    assert got == [(0, "one"), (0, "two"), (1, "two")]
    assert [r.delivery_id for r in mq.unrouted(messages, bindings).collect()] == [2]


def test_a_body_is_parsed_once_per_handler(spark):
    handler = mq.Handler("h", "a", "k.*", SIMPLE)
    plan = mq.process(queue(spark, [("a", "k.x", "{}")]).repartition(2), [handler])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("parseJson") == 1


# --- metadata ------------------------------------------------------------------------------

PAIR = '<meta name="itemId" value="VX-1234"/>'
INFO = (
    '<meta-movie-info><meta-movie tokens="a" /><meta-track tokens="b" /><meta-video-track tokens="c" />'
    '<meta-audio-track tokens="d" /><meta-hint-track tokens="e" /></meta-movie-info>'
)


def document(content=PAIR, before="", head='<?xml version="1.0"?>\n        '):
    return f'{head}<meta-data>{before}<meta-group type="movie meta">{content}</meta-group></meta-data>'


DOCUMENTS = [
    (document(), True),
    (document(before=INFO), True),
    (document(before=INFO, head=""), True),
    (document(head='<?xml version="1.0" encoding="UTF-8"?>'), True),
    (document(PAIR + "<!-- remark -->" + PAIR), True),
    (document('<meta value="v" name="n"></meta>'), True),
    (document('<meta name="n" value="a &amp; &#10; &quot; – é"/>'), True),
    (document().replace(' type="movie meta"', ""), True),
    (document(PAIR.replace("value", "vilue")), False),
    (document().replace("</meta-data>", ""), False),
    (document(""), False),
    (document(PAIR + "text"), False),
    (document('<meta name="n" value="v"> </meta>'), False),
    (document('<meta name="n" name="n" value="v"/>'), False),
    (document('<meta name="n" value="a & b"/>'), False),
    (document('<meta name="n" value="a < b"/>'), False),
    (document('<meta name="n"/>'), False),
    (document(before=INFO + INFO), False),
    (document(before=INFO.replace('tokens="a"', "")), False),
    (document(before='<meta-movie-info><meta-track tokens="b"/><meta-movie tokens="a"/></meta-movie-info>'), False),
    (document().replace("meta-data", "other"), False),
    (document().replace("</meta-data>", INFO + "</meta-data>"), False),
    ("not xml", False),
    ("", False),
    (None, False),
]


def test_metadata_documents(spark):
    df = spark.createDataFrame([(i, d) for i, (d, _) in enumerate(DOCUMENTS)], "i INT, x STRING")
    got = metadata.parse_metadata(df, "x").orderBy("i").collect()
    assert [(i, r.metadata_valid) for i, r in enumerate(got)] == [(i, ok) for i, (_, ok) in enumerate(DOCUMENTS)]
    assert got[0].metadata_type == "movie meta"
    assert [tuple(p) for p in got[6].metadata_pairs] == [("n", 'a & \n " – é')]


def test_plain_documents_skip_the_full_check(column):
    plain = column([d for d, _ in DOCUMENTS], lambda c: c.rlike(metadata._plain_document()))
    assert plain[:3] == [True, True, True] and plain[5:8] == [True, True, True]
    assert not any(plain[8:])


def test_very_long_document(spark):
    body = document(PAIR * 200_000)
    df = spark.createDataFrame([(body,)], "x STRING")
    row = metadata.parse_metadata(df, "x").select("metadata_valid", F.size("metadata_pairs")).first()
    assert tuple(row) == (True, 200_000)


parts = st.sampled_from(
    [PAIR, INFO, "<meta-group>", "</meta-group>", "<meta-data>", "</meta-data>", " ", "x", "<!-- c -->",
     '<meta-group type="t">', '<meta value="1" name="2"></meta>', '<meta name="&lt;" value=""/>', "<meta-movie-info/>"]
)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(parts, max_size=4), min_size=30, max_size=60))
def test_short_cut_agrees_with_the_full_check(spark, tmp_path_factory, middles):
    texts = []
    for i, m in enumerate(middles):
        texts.append(document("".join(m)) if i % 2 else "<meta-data>" + "".join(m) + "</meta-data>")
    other = tmp_path_factory.mktemp("xsd") / f"copy-{len(texts)}.xsd"
    other.write_text(metadata.SCHEMA_FILE.read_text())
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, x STRING")
    short = metadata.parse_metadata(df, "x").orderBy("i").select("metadata_valid", "metadata_pairs").collect()
    full = metadata.parse_metadata(df, "x", str(other)).orderBy("i").select("metadata_valid", "metadata_pairs").collect()
    assert short == full


def test_invalid_metadata_produces_an_outcome(spark):
    body = json.dumps({"inmeta": "<broken", "routename": "r"})
    handler = mq.Handler("u", "e", "#", fixed.UPLOAD_SCHEMA, launch.check_metadata, sees_all=True)
    row = mq.process(queue(spark, [("e", "k", body)]), [handler]).first()
    assert (row.disposition, row.reason, row.outcome_key) == ("dead_letter", "xml", "cds.job.invalid")
    assert json.loads(row.outcome_body) == {"inmeta": "<broken", "routename": "r", "error": "metadata is not valid"}


def test_outcome_body_of_an_empty_object(column):
    got = column(["{}", '{"a":1}\n', '{"a":"}"}'], lambda c: launch.outcome_body(c, {"e": F.lit("x")}))
    assert [json.loads(g) for g in got] == [{"e": "x"}, {"a": 1, "e": "x"}, {"a": "}", "e": "x"}]
