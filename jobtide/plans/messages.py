"""Queries over queue messages and metadata documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from jobtide import fixed
from jobtide.functions import names
from jobtide.operators import launch, messages as mq, metadata, routing
from jobtide.operators.spread import spread
from jobtide.plans.adapters import table, view, with_views

REQUESTS, JOBS = "requests", "jobs"
QUEUE_PREFIX = "queue-"

UPLOAD_HANDLER = mq.Handler(
    "uploads", REQUESTS, fixed.UPLOAD_PATTERN, fixed.UPLOAD_SCHEMA, launch.check_metadata, sees_all=True
)
STATUS_HANDLER = mq.Handler("statuses", JOBS, fixed.STATUS_PATTERN, fixed.STATUS_SCHEMA)
EVERYTHING = mq.Binding(JOBS, "cds.#", "everything")
BINDINGS = [UPLOAD_HANDLER.binding, STATUS_HANDLER.binding, EVERYTHING]


def uploads(spark: SparkSession, sf: str) -> DataFrame:
    """Upload messages as they arrive, bodies as bytes."""
    messages = view(spark, sf, "upload_messages").withColumn("body", F.col("body").cast("binary"))
    return spread(messages, "delivery_id")


def statuses(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "status_deliveries").withColumn("body", F.col("body").cast("binary"))


def deliveries(spark: SparkSession, sf: str) -> DataFrame:
    return uploads(spark, sf).unionByName(statuses(spark, sf))


# --- check queries: the verdict follows from how the bodies are made ------------------

_UPLOAD_REASON = """CASE WHEN delivery_id % 31 = 0 THEN 'no_binding'
    WHEN delivery_id % 19 = 0 THEN 'not_json' WHEN delivery_id % 13 = 0 THEN 'missing:routename'
    WHEN delivery_id % 17 = 0 THEN 'type:deliverable_asset'
    WHEN delivery_id % 29 = 0 OR delivery_id % 23 = 0 THEN 'xml' END"""
_STATUS_REASON = """CASE WHEN delivery_id % 17 = 0 THEN 'not_json'
    WHEN delivery_id % 11 = 0 THEN 'missing:job-namespace' WHEN delivery_id % 13 = 0 THEN 'type:job-id'
    WHEN delivery_id % 6 >= 3 THEN 'type:retry-count' END"""
_VERDICTS = f"""
    SELECT *, CASE WHEN reason IS NULL THEN 'ack' WHEN reason = 'no_binding' THEN 'unrouted' ELSE 'dead_letter' END AS disposition,
        CASE WHEN reason = 'no_binding' THEN NULL ELSE handler_name END AS handler
    FROM (SELECT *, 'uploads' AS handler_name, {_UPLOAD_REASON} AS reason FROM upload_messages
        UNION ALL SELECT *, 'statuses', {_STATUS_REASON} FROM status_deliveries)"""


def verdicts_sql(**more: str) -> str:
    return with_views("upload_messages", "status_deliveries", verdicts=_VERDICTS, **more)


def message_disposition(spark, sf):
    done = mq.process(deliveries(spark, sf), [UPLOAD_HANDLER, STATUS_HANDLER])
    return done.select("exchange", "delivery_id", "handler", "disposition", "reason")


DISPOSITION_SQL = verdicts_sql() + """
SELECT exchange, delivery_id, handler, disposition, reason FROM verdicts"""


def dead_letters_by_reason(spark, sf):
    done = mq.process(deliveries(spark, sf), [UPLOAD_HANDLER, STATUS_HANDLER])
    return (
        done.where(F.col("disposition") == mq.DEAD_LETTER)
        .groupBy("handler", "reason")
        .agg(F.count(F.lit(1)).alias("messages"))
    )


DEAD_SQL = verdicts_sql() + """
SELECT handler, reason, count(*) AS messages FROM verdicts WHERE disposition = 'dead_letter' GROUP BY 1, 2"""


def disposition_totals(spark, sf):
    from jobtide.streaming.runner import conserved

    return conserved(mq.process(deliveries(spark, sf), [UPLOAD_HANDLER, STATUS_HANDLER]))


TOTALS_SQL = verdicts_sql() + """
SELECT disposition, count(*) AS messages FROM verdicts GROUP BY 1"""


def invalid_outcomes(spark, sf):
    done = mq.process(uploads(spark, sf), [UPLOAD_HANDLER])
    return done.where(F.col("outcome_key").isNotNull()).select(
        "delivery_id", "outcome_key", "outcome_body"
    )


INVALID_SQL = verdicts_sql() + """
SELECT delivery_id, 'cds.job.invalid' AS outcome_key,
    left(body, length(body) - 1) || ',"error":"metadata is not valid"}' AS outcome_body
FROM verdicts WHERE handler = 'uploads' AND reason = 'xml'"""


def no_schema_requeue(spark, sf):
    blind = mq.Handler("blind", JOBS, fixed.STATUS_PATTERN, None)
    done = mq.process(statuses(spark, sf), [blind])
    return done.groupBy("routing_key", "disposition", "reason").agg(
        F.count(F.lit(1)).alias("messages")
    )


NO_SCHEMA_SQL = with_views("status_deliveries") + """
SELECT routing_key, 'requeue' AS disposition, 'no_schema' AS reason, count(*) AS messages
FROM status_deliveries GROUP BY 1"""


def topic_match(spark, sf):
    routed = mq.route(deliveries(spark, sf), BINDINGS)
    return routed.groupBy(
        "exchange",
        "handler",
        "pattern",
        names.queue_name(F.col("pattern"), QUEUE_PREFIX).alias("queue"),
        names.platform(F.col("routing_key")).alias("platform"),
    ).agg(F.count(F.lit(1)).alias("messages"))


TOPIC_SQL = with_views(
    "upload_messages",
    "status_deliveries",
    bindings=r"""SELECT * FROM (VALUES
        ('requests', 'uploads', 'deliverables.syndication.*.upload', '^deliverables\.syndication\.[^.]+\.upload$'),
        ('jobs', 'statuses', 'cds.job.*', '^cds\.job\.[^.]+$'),
        ('jobs', 'everything', 'cds.#', '^cds(\.[^.]+)*$')) AS b(exchange, handler, pattern, regex)""",
    deliveries="SELECT exchange, routing_key FROM upload_messages UNION ALL SELECT exchange, routing_key FROM status_deliveries",
) + """
SELECT exchange, handler, pattern, 'queue-' || regexp_replace(pattern, '[^A-Za-z0-9_]', '', 'g') AS queue,
    CASE WHEN handler = 'uploads' THEN split_part(routing_key, '.', 3) END AS platform, count(*) AS messages
FROM deliveries JOIN bindings b USING (exchange) WHERE regexp_matches(routing_key, b.regex)
GROUP BY ALL"""


def _order_exchange(customer: str) -> Column:
    return F.concat(F.lit("orders-"), F.col(customer) % 3).alias("exchange")


def _order_messages(spark: SparkSession, sf: str) -> DataFrame:
    words = F.concat_ws(".", F.lit("order"), F.col("o_custkey"), F.col("o_orderstatus"), F.substring("o_orderpriority", 1, 1))
    return table(spark, sf, "orders").select(_order_exchange("o_custkey"), words.alias("routing_key"), "o_orderkey")


def _order_bindings(spark: SparkSession, sf: str) -> DataFrame:
    """A queue for each customer, bound by one of seven kinds of pattern, and one for all orders of each exchange."""
    kinds = ("order.{}.*.*", "order.{}.F.#", "#.{}.*.1", "*.{}.O.*", "#.{}.#.2.#", "order.{}", "order.{}.P.*")
    kind = F.element_at(F.array(*map(F.lit, kinds)), (F.col("c_custkey") % 7 + 1).cast("int"))
    pattern = F.replace(kind, F.lit("{}"), F.col("c_custkey").cast("string"))
    customers = table(spark, sf, "customer").select("c_custkey", _order_exchange("c_custkey"), pattern.alias("pattern"))
    each = customers.select("exchange", F.concat(F.lit("customer-"), F.col("c_custkey")).alias("handler"), "pattern")
    everything = customers.select("exchange").distinct().select("exchange", F.lit("everything").alias("handler"), F.lit("order.#").alias("pattern"))
    return each.unionByName(everything)


def topic_table(spark, sf):
    """Messages per binding, with as many bindings as there are customers."""
    routed = routing.route_by_table(_order_messages(spark, sf), _order_bindings(spark, sf))
    return routed.groupBy("handler", "pattern").agg(F.count(F.lit(1)).alias("messages"), F.min("o_orderkey").alias("first_order"))


TOPIC_TABLE_SQL = """
WITH placed AS (SELECT o_orderkey, o_custkey AS c, o_orderstatus AS s, left(o_orderpriority, 1) AS p, o_custkey % 7 AS kind FROM orders)
SELECT 'customer-' || c AS handler,
    CASE kind WHEN 0 THEN 'order.' || c || '.*.*' WHEN 1 THEN 'order.' || c || '.F.#' WHEN 2 THEN '#.' || c || '.*.1'
        WHEN 3 THEN '*.' || c || '.O.*' WHEN 4 THEN '#.' || c || '.#.2.#' ELSE 'order.' || c || '.P.*' END AS pattern,
    count(*) AS messages, min(o_orderkey) AS first_order
FROM placed JOIN customer ON c_custkey = c
WHERE kind = 0 OR (kind = 1 AND s = 'F') OR (kind = 2 AND p = '1') OR (kind = 3 AND s = 'O') OR (kind = 4 AND p = '2') OR (kind = 6 AND s = 'P')
GROUP BY 1, 2
UNION ALL SELECT 'everything', 'order.#', count(*), min(o_orderkey) FROM placed"""


def unrouted_messages(spark, sf):
    return mq.unrouted(deliveries(spark, sf), BINDINGS).select("exchange", "routing_key", "delivery_id")


UNROUTED_SQL = with_views("upload_messages") + r"""
SELECT exchange, routing_key, delivery_id FROM upload_messages
WHERE NOT regexp_matches(routing_key, '^deliverables\.syndication\.[^.]+\.upload$')"""


def integer_rules(spark, sf):
    """Verdict, value and label of integers, also beyond 64 bits and beyond the reach of a double."""
    bodies = view(spark, sf, "typed_bodies")
    checked = mq.validate(bodies, fixed.UPLOAD_SCHEMA)
    label = launch.request_labels(checked.columns)["deliverable-asset-id"]
    good = F.col("disposition") == mq.ACK
    return checked.select(
        "delivery_id", "disposition", "reason", "routename",
        F.when(good, F.col("deliverable_asset").cast("string")).alias("value"),
        F.when(good, label).alias("label"),
    )


INTEGER_SQL = with_views("typed_bodies") + """
SELECT delivery_id, CASE WHEN good THEN 'ack' ELSE 'dead_letter' END AS disposition,
    CASE WHEN NOT good THEN 'type:deliverable_asset' END AS reason, 'r' AS routename, value, CASE WHEN good THEN coalesce(value, 'None') END AS label
FROM (SELECT delivery_id, delivery_id % 11 IN (0, 1, 2, 7, 10) AS good,
    CASE delivery_id % 11 WHEN 1 THEN '7' WHEN 2 THEN '7' WHEN 7 THEN '123456789012345678901234567890' WHEN 10 THEN '9007199254740993' END AS value
    FROM typed_bodies)"""


def status_message_fields(spark, sf):
    checked = mq.validate(statuses(spark, sf), fixed.STATUS_SCHEMA)
    return checked.where(F.col("disposition") == mq.ACK).select(
        "delivery_id", "job_id", "job_name", "job_namespace",
        F.col("retry_count").cast("bigint").alias("retry_count"),
    )


FIELDS_SQL = verdicts_sql() + """
SELECT delivery_id, 'uid-' || CAST(delivery_id AS VARCHAR) AS job_id, 'cds-' || CAST(delivery_id AS VARCHAR) AS job_name,
    'ns' AS job_namespace, CAST(CASE delivery_id % 6 WHEN 1 THEN 3 WHEN 2 THEN 2 END AS BIGINT) AS retry_count
FROM verdicts WHERE handler = 'statuses' AND disposition = 'ack'"""


def oversize_messages(spark, sf):
    """Texts as outgoing messages for a broker that takes 4 KiB each."""
    outgoing = table(spark, sf, "documents").select("doc_id", F.col("text").alias("body"))
    return mq.check_size(outgoing, 4096).select("doc_id", "disposition", "reason")


OVERSIZE_SQL = """
SELECT doc_id, CASE WHEN strlen(text) > 4096 THEN 'dead_letter' ELSE 'ack' END AS disposition,
    CASE WHEN strlen(text) > 4096 THEN 'body_too_long' END AS reason FROM documents"""


# --- metadata ----------------------------------------------------------------------------


def _documents(spark, sf) -> DataFrame:
    return metadata.parse_metadata(spread(view(spark, sf, "metadata_docs"), "doc"), "xml")


def metadata_valid(spark, sf):
    return _documents(spark, sf).select("doc", "metadata_valid", "metadata_type")


_GOOD = "p_partkey % 7 <> 0 AND p_partkey % 11 <> 0 AND p_partkey % 13 <> 0"
VALID_SQL = f"""
SELECT p_partkey AS doc,
    p_partkey % 11 <> 0 AND p_partkey % 13 <> 0 AND p_partkey % 7 <> 0 AS metadata_valid,
    CASE WHEN {_GOOD} THEN 'movie meta' END AS metadata_type FROM part"""


def metadata_pairs(spark, sf):
    rows = metadata.metadata_rows(_documents(spark, sf), "doc")
    return rows.withColumn("position", F.col("position").cast("bigint"))


PAIRS_SQL = f"""
WITH good AS (SELECT * FROM part WHERE {_GOOD})
SELECT p_partkey AS doc, CAST(0 AS BIGINT) AS position, 'name' AS name, p_name || ' & <"' AS value FROM good
UNION ALL SELECT p_partkey, 1, 'brand', p_brand FROM good
UNION ALL SELECT p_partkey, 2, 'type', p_type FROM good
UNION ALL SELECT p_partkey, 3, 'size', CAST(p_size AS VARCHAR) FROM good"""


def metadata_values(spark, sf):
    parsed = _documents(spark, sf).where("metadata_valid")
    wanted = ("brand", "type", "size", "absent")
    return parsed.select("doc", *[metadata.metadata_value(n).alias(f"meta_{n}") for n in wanted])


VALUES_SQL = f"""
SELECT p_partkey AS doc, p_brand AS meta_brand, p_type AS meta_type, CAST(p_size AS VARCHAR) AS meta_size,
    CAST(NULL AS VARCHAR) AS meta_absent FROM part WHERE {_GOOD}"""



def movie_tokens(spark, sf):
    """Token lists of the movie information of the valid documents."""
    parsed = _documents(spark, sf).where("metadata_valid")
    return parsed.select("doc", F.explode("movie_tokens").alias("part", "tokens"))


TOKENS_SQL = f"""
SELECT p_partkey AS doc, 'meta-movie' AS part, p_brand AS tokens FROM part WHERE {_GOOD} AND p_partkey % 3 = 0
UNION ALL SELECT p_partkey, 'meta-video-track', 'width height' FROM part WHERE {_GOOD} AND p_partkey % 3 = 0"""

QUERIES = {
    "movie_tokens": (movie_tokens, TOKENS_SQL),
    "message_disposition": (message_disposition, DISPOSITION_SQL),
    "dead_letters_by_reason": (dead_letters_by_reason, DEAD_SQL),
    "disposition_totals": (disposition_totals, TOTALS_SQL),
    "invalid_outcomes": (invalid_outcomes, INVALID_SQL),
    "no_schema_requeue": (no_schema_requeue, NO_SCHEMA_SQL),
    "topic_match": (topic_match, TOPIC_SQL),
    "topic_table": (topic_table, TOPIC_TABLE_SQL),
    "unrouted_messages": (unrouted_messages, UNROUTED_SQL),
    "integer_rules": (integer_rules, INTEGER_SQL),
    "status_message_fields": (status_message_fields, FIELDS_SQL),
    "oversize_messages": (oversize_messages, OVERSIZE_SQL),
    "metadata_valid": (metadata_valid, VALID_SQL),
    "metadata_pairs": (metadata_pairs, PAIRS_SQL),
    "metadata_values": (metadata_values, VALUES_SQL),
}
