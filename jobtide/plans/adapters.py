"""Views that give the given tables the shape of events, messages, jobs and logs.

The expressions are written in the common part of both SQL dialects, so that a view is the
same set of rows for the Spark query and for the check query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_Q = "chr(39)"


def _text(column: str) -> str:
    return f"CAST({column} AS STRING)"


_EVENTS = {
    "event_id": "event_id",
    "ts": "ts",
    "resource_version": "event_id + 1",
    "watch_type": "CASE WHEN event_id % 19 = 0 THEN 'DELETED' WHEN event_type = 'signup' THEN 'ADDED' ELSE 'MODIFIED' END",
    "object_kind": "CASE WHEN event_id % 23 = 0 THEN 'Status' ELSE 'Job' END",
    "uid": f"'uid-' || {_text('user_id')}",
    "name": f"CASE WHEN user_id % 10 = 0 THEN 'backup-' ELSE 'cds-' END || {_text('user_id')}",
    "namespace": f"'ns' || {_text('user_id % 3')}",
    "active": "CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 1 WHEN 'error' THEN 0 END",
    "failed": (
        "CAST(CASE WHEN event_type = 'view' AND event_id % 2 = 0 THEN 0"
        " WHEN event_type = 'click' THEN 1 + event_id % 3"
        " WHEN event_type = 'error' THEN 1 + event_id % 4 END AS INT)"
    ),
    "succeeded": "CASE event_type WHEN 'purchase' THEN 1 END",
    "start_time": (
        "CASE WHEN event_type = 'signup' AND event_id % 31 <> 0 THEN NULL"
        " WHEN event_type = 'error' AND event_id % 29 = 0 THEN NULL ELSE ts END"
    ),
}

_XML = (
    f"'<?xml version=' || {_Q} || '1.0' || {_Q} || '?><meta-data><meta-group type=' || {_Q} || 'movie meta' || {_Q}"
    f" || '><meta name=' || {_Q} || 'itemId' || {_Q} || CASE WHEN o_orderkey % 23 = 0 THEN ' vilue=' ELSE ' value=' END"
    f" || {_Q} || 'VX-' || {_text('o_orderkey')} || {_Q} || '/><meta name=' || {_Q} || 'priority' || {_Q}"
    f" || ' value=' || {_Q} || o_orderpriority || {_Q} || '/></meta-group>'"
    " || CASE WHEN o_orderkey % 29 = 0 THEN '' ELSE '</meta-data>' END"
)

# Hint fields cover each step of the order of precedence: value, empty text, null, absent.
_FULL_BODY = (
    "'{\"deliverable_bundle\":' || " + _text("o_custkey")
    + " || ',\"deliverable_asset\":' || CASE WHEN o_orderkey % 17 = 0 THEN '\"x\"' ELSE " + _text("o_orderkey") + " END"
    + " || ',\"inmeta\":\"' || " + _XML + " || '\"'"
    + " || CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE ',\"routename\":\"route-' || " + _text("o_custkey % 7") + " || '.xml\"' END"
    + " || CASE o_orderkey % 8 WHEN 0 THEN ',\"filename\":null' WHEN 1 THEN '' WHEN 2 THEN ',\"filename\":\"\"'"
    + " WHEN 4 THEN '' WHEN 5 THEN ',\"filename\":null'"
    + " ELSE ',\"filename\":\"Clip ' || " + _text("o_custkey % 50") + " || ' take.mxf\"' END"
    + " || CASE o_orderkey % 3 WHEN 0 THEN ',\"online_id\":null' WHEN 1 THEN '' ELSE ',\"online_id\":\"KP-' || " + _text("o_custkey") + " || '\"' END"
    + " || CASE o_orderkey % 5 WHEN 0 THEN ',\"nearline_id\":null' WHEN 1 THEN ''"
    + " ELSE ',\"nearline_id\":\"a very long name of the nearline store item that goes on and on until it is cut ' || " + _text("o_orderkey") + " || '\"' END"
    + " || CASE o_orderkey % 7 WHEN 0 THEN ',\"archive_id\":null' WHEN 1 THEN '' ELSE ',\"archive_id\":\"AR ' || " + _text("o_orderkey") + " || '\"' END"
    + " || '}'"
)

# Some bodies are cut off in the middle.
_BODY = f"substr({_FULL_BODY}, 1, CASE WHEN o_orderkey % 19 = 0 THEN 60 ELSE 1000000 END)"

_UPLOADS = {
    "exchange": "'requests'",
    "routing_key": (
        "CASE WHEN o_orderkey % 31 = 0 THEN 'deliverables.other.x'"
        " ELSE 'deliverables.syndication.' || lower(substr(o_orderpriority, 3, 3)) || '.upload' END"
    ),
    "delivery_id": "o_orderkey",
    "body": _BODY,
    "attempt": "1",
}

_STATUS_BODY = (
    "'{\"job-name\":\"cds-' || " + _text("o_orderkey") + " || '\"'"
    + " || CASE WHEN o_orderkey % 13 = 0 THEN ',\"job-id\":' || " + _text("o_orderkey")
    + " ELSE ',\"job-id\":\"uid-' || " + _text("o_orderkey") + " || '\"' END"
    + " || CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE ',\"job-namespace\":\"ns\"' END"
    + " || CASE o_orderkey % 6 WHEN 0 THEN '' WHEN 1 THEN ',\"retry-count\":3' WHEN 2 THEN ',\"retry-count\":2.5'"
    + " WHEN 3 THEN ',\"retry-count\":\"4\"' WHEN 4 THEN ',\"retry-count\":null' ELSE ',\"retry-count\":true' END"
    + " || CASE WHEN o_orderkey % 17 = 0 THEN '} trailing' ELSE '}' END"
)

_METADATA = (
    f"'<meta-data>' || CASE WHEN p_partkey % 3 = 0 THEN '<meta-movie-info><meta-movie tokens=' || {_Q} || p_brand || {_Q} || '/>'"
    f" || '<meta-video-track tokens=' || {_Q} || 'width height' || {_Q} || '/></meta-movie-info>'"
    " WHEN p_partkey % 5 = 0 THEN '<meta-movie-info/>' ELSE '' END ||"
    f" '<meta-group type=' || {_Q} || 'movie meta' || {_Q} || '>'"
    " || CASE WHEN p_partkey % 13 = 0 THEN '' ELSE"
    f" '<meta name=' || {_Q} || 'name' || {_Q} || CASE WHEN p_partkey % 7 = 0 THEN ' vilue=' ELSE ' value=' END || {_Q}"
    f" || p_name || ' &amp; &lt;&quot;' || {_Q} || '/>'"
    f" || '<meta name=' || {_Q} || 'brand' || {_Q} || ' value=' || {_Q} || p_brand || {_Q} || '/>'"
    f" || '<meta name=' || {_Q} || 'type' || {_Q} || ' value=' || {_Q} || p_type || {_Q} || '/>'"
    f" || '<meta name=' || {_Q} || 'size' || {_Q} || ' value=' || {_Q} || {_text('p_size')} || {_Q} || '/>' END"
    " || '</meta-group>' || CASE WHEN p_partkey % 11 = 0 THEN '' ELSE '</meta-data>' END"
)

_MINUTE = "INTERVAL 1 MINUTE"

VIEWS: dict[str, tuple[str, dict[str, str]]] = {
    "job_events": ("events", _EVENTS),
    "upload_messages": ("orders", _UPLOADS),
    "status_deliveries": (
        "orders",
        {
            "exchange": "'jobs'",
            "routing_key": "'cds.job.' || CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'P' THEN 'success' ELSE 'running' END",
            "delivery_id": "o_orderkey",
            "body": _STATUS_BODY,
            "attempt": "1",
        },
    ),
    "typed_bodies": (
        "orders",
        {
            "delivery_id": "o_orderkey",
            "body": (
                "'{\"routename\":\"r\",\"inmeta\":\"m\"' || CASE o_orderkey % 11 WHEN 0 THEN '' WHEN 1 THEN ',\"deliverable_asset\":7'"
                " WHEN 2 THEN ',\"deliverable_asset\":7.0' WHEN 3 THEN ',\"deliverable_asset\":7.5'"
                " WHEN 4 THEN ',\"deliverable_asset\":true' WHEN 5 THEN ',\"deliverable_asset\":null'"
                " WHEN 6 THEN ',\"deliverable_asset\":\"7\"' WHEN 7 THEN ',\"deliverable_asset\":123456789012345678901234567890'"
                " WHEN 8 THEN ',\"deliverable_asset\":[7]' WHEN 9 THEN ',\"deliverable_asset\":9007199254740993.5'"
                " ELSE ',\"deliverable_asset\":9007199254740993' END || ',\"junk_field\":{\"a\":[1,2]}}'"
            ),
        },
    ),
    "job_messages": (
        "orders",
        {
            "order_key": "o_orderkey",
            "job_name": f"'cds-' || {_text('o_orderkey')}",
            "job_namespace": f"'ns' || {_text('o_orderkey % 3')}",
            "routing_key": "'cds.job.' || CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'P' THEN 'success' ELSE 'running' END",
            "keep_text": "CASE o_orderkey % 5 WHEN 0 THEN 'yes' WHEN 1 THEN 'no' WHEN 2 THEN 'TRUE' WHEN 3 THEN 'False' END",
        },
    ),
    "pods": (
        "lineitem",
        {
            "job_name": f"'cds-' || {_text('l_orderkey')}",
            "job_namespace": f"'ns' || {_text('l_orderkey % 3')}",
            "log_size": "CAST(l_quantity AS BIGINT)",
        },
    ),
    "job_conditions": (
        "lineitem",
        {
            "job": "l_orderkey",
            "last_probe_time": "l_shipdate",
            "reason": "l_returnflag",
            "message": "l_linestatus",
            "n1": "l_linenumber",
            "n2": "l_partkey",
            "n3": "l_suppkey",
        },
    ),
    "metadata_docs": ("part", {"doc": "p_partkey", "xml": _METADATA}),
    "filename_requests": ("part", {"delivery_id": "p_partkey", "part_name": "p_name"}),
    "log_files": (
        "documents",
        {
            "doc_id": "doc_id",
            "route": "CASE WHEN doc_id % 37 = 0 THEN '.' || source ELSE source END",
            "log": f"{_text('doc_id')} || '.log'",
            "size": (
                "CASE doc_id % 4 WHEN 0 THEN n_chars WHEN 1 THEN n_chars * 1000"
                " WHEN 2 THEN n_chars * 1000000 ELSE n_chars * 1000000000 END"
            ),
            "last_modified": f"TIMESTAMP '2024-01-01 00:00:00' + CAST(doc_id AS INT) * 480 * {_MINUTE}",
            "text": "text",
        },
    ),
    "tail_lines": (
        "conversations",
        {
            "route": f"'r' || {_text('conv_id % 5')}",
            "log": f"{_text('conv_id')} || '.log'",
            "conv_id": "conv_id",
            "line_no": "turn",
            "line": "text",
            "last_modified": f"TIMESTAMP '2024-01-01 00:00:00' + CAST(conv_id AS INT) * {_MINUTE}",
        },
    ),
    "pod_lines": (
        "conversations",
        {
            "job_name": f"'cds-' || {_text('conv_id % 20')}",
            "job_namespace": "'ns0'",
            "pod_name": f"'pod-' || {_text('conv_id')}",
            "line_no": "turn",
            "line": "replace(text, chr(10), ' ')",
            "job_number": "conv_id % 20",
        },
    ),
    "log_pointers": (
        "labels",
        {
            "job_name": f"'cds-' || {_text('doc_id')}",
            "log_path": (
                "'/var/log/cds_backend/' || CASE WHEN doc_id % 11 = 0 THEN '../other/' ELSE '' END || 'src'"
                f" || {_text('doc_id % 20')} || '/' || {_text('doc_id')} || '.log'"
                " || CASE WHEN quality = 0 THEN '  ' || chr(10) ELSE '' END"
            ),
            "doc_id": "doc_id",
        },
    ),
    "stored_states": (
        "customer",
        {
            "uid": f"'uid-' || {_text('c_custkey')}",
            "state_json": (
                "CASE c_custkey % 5 WHEN 0 THEN 'not json'"
                f" WHEN 1 THEN '{{\"uid\":\"uid-' || {_text('c_custkey')} || '\",\"name\":\"n\",\"status\":\"running\"}}'"
                f" ELSE '{{\"uid\":\"uid-' || {_text('c_custkey')} || '\",\"name\":\"n\",\"status\":\"running\",\"timestamp\":' || {_text('c_custkey')} || '.5}}' END"
            ),
        },
    ),
    "journal_texts": (
        "events",
        {
            "event_id": "event_id",
            "position_text": (
                f"CASE event_id % 6 WHEN 0 THEN {_text('event_id')} WHEN 1 THEN 'abcde' WHEN 2 THEN '12.5'"
                f" WHEN 3 THEN ' ' || {_text('event_id')} || ' ' WHEN 4 THEN '-' || {_text('event_id')} END"
            ),
        },
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, columns = VIEWS[name]
    return table(spark, sf_dir, source).selectExpr(
        *[f"{expression} AS {column}" for column, expression in columns.items()]
    )


def with_views(*names: str, **more: str) -> str:
    """The WITH clause that defines views (and further named queries) in SQL."""
    parts = []
    for name in names:
        source, columns = VIEWS[name]
        body = ", ".join(f"{expression} AS {column}" for column, expression in columns.items())
        parts.append(f"{name} AS (SELECT {body} FROM {source})")
    parts.extend(f"{name} AS ({body})" for name, body in more.items())
    return "WITH " + ",\n".join(parts)
