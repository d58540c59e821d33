"""Queue messages: topic routing, schema check, disposition."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from jobtide.functions.topics import topic_regex
from jobtide.operators.once import evaluate_once

ACK, REQUEUE, DEAD_LETTER, UNROUTED = "ack", "requeue", "dead_letter", "unrouted"

MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("exchange", T.StringType()),
        T.StructField("routing_key", T.StringType()),
        T.StructField("delivery_id", T.LongType()),
        T.StructField("body", T.BinaryType()),
        T.StructField("attempt", T.IntegerType()),
    ]
)


# --- topic routing -------------------------------------------------------------------


@dataclass(frozen=True)
class Binding:
    """A queue of one handler, fed by an exchange through a topic pattern."""

    exchange: str
    pattern: str
    handler: str


def fits(binding: Binding) -> Column:
    """Does the message reach the queue of the binding?"""
    return (F.col("exchange") == binding.exchange) & F.col("routing_key").rlike(
        topic_regex(binding.pattern)
    )


def matching_bindings(bindings: Sequence[Binding]) -> Column:
    """Array of the bindings that a message fits.

    The binding list is configuration.  Its patterns are compiled into the expression, so
    routing is a projection: no join and no shuffle, whatever the number of messages.
    """
    hits = [
        F.when(
            fits(b), F.struct(F.lit(b.handler).alias("handler"), F.lit(b.pattern).alias("pattern"))
        )
        for b in bindings
    ]
    return F.array_compact(F.array(*hits))


def route(messages: DataFrame, bindings: Sequence[Binding]) -> DataFrame:
    """One row per message and queue it is delivered to, with ``handler`` and ``pattern``."""
    return (
        messages.withColumn("__hit", F.explode(matching_bindings(bindings)))
        .withColumns({"handler": F.col("__hit.handler"), "pattern": F.col("__hit.pattern")})
        .drop("__hit")
    )


def unrouted(messages: DataFrame, bindings: Sequence[Binding]) -> DataFrame:
    """Messages that no queue receives."""
    reached = reduce(lambda a, b: a | b, (fits(b) for b in bindings), F.lit(False))
    return messages.where(~F.coalesce(reached, F.lit(False)))


# --- schema check ----------------------------------------------------------------------

# JSON types against the type text of a variant value.  A number counts as an integer when
# it has no fraction (1.0 does), true and false are not numbers.
_NUMBER = r"^(?:BIGINT|DECIMAL\(.*|DOUBLE|FLOAT)$"


_WHOLE = r"^-?[0-9]+(?:\.0*)?$"


def _type_test(kind: str, typed: Column, number: Column) -> Column:
    """``number`` is the value's text; only a binary float is judged by its value."""
    tests = {
        "string": lambda: typed == "STRING",
        "boolean": lambda: typed == "BOOLEAN",
        "null": lambda: typed == "VOID",
        "object": lambda: typed.startswith("OBJECT"),
        "array": lambda: typed.startswith("ARRAY"),
        "number": lambda: typed.rlike(_NUMBER),
        "integer": lambda: (typed == "BIGINT")
        | (typed.startswith("DECIMAL") & number.rlike(_WHOLE))
        | (typed.isin("DOUBLE", "FLOAT") & (number.try_cast("double") % 1 == 0)),
    }
    if kind not in tests:
        raise ValueError(f"unsupported JSON type: {kind}")
    return tests[kind]()


# integers of JSON have any length: a column holds those of up to 38 digits, their text holds all
_SPARK_TYPES = {"string": "string", "integer": "decimal(38,0)", "number": "double", "boolean": "boolean"}
TEXT_OF = "{}_text"


@dataclass(frozen=True)
class MessageCheck:
    """A message schema compiled into columns: type and presence checks per known field.

    Fields the schema does not name are allowed.  Only ``type``, ``properties`` and
    ``required`` are understood; anything else is refused when compiling.
    """

    types: dict[str, tuple[str, ...]]
    required: tuple[str, ...]

    @classmethod
    def compile(cls, schema: dict) -> "MessageCheck":
        unknown = set(schema) - {"type", "properties", "required"}
        if unknown or schema.get("type") != "object":
            raise ValueError(f"unsupported message schema: {sorted(unknown) or schema.get('type')}")
        types = {}
        for field, rule in schema.get("properties", {}).items():
            if set(rule) - {"type"}:
                raise ValueError(f"unsupported rule for {field}: {rule}")
            kinds = rule.get("type", ())
            types[field] = (kinds,) if isinstance(kinds, str) else tuple(kinds)
            for kind in types[field]:
                _type_test(kind, F.lit(""), F.lit(""))
        return cls(types, tuple(schema.get("required", ())))

    @property
    def fields(self) -> list[str]:
        return [*self.types, *[r for r in self.required if r not in self.types]]

    def facts(self, document: str, text: str) -> Column:
        """What the rules look at: is it an object, and the type of each known field."""
        is_object = F.col(text).rlike(r"^[ \t\r\n]*\{")
        parts = [F.when(F.col(document).isNotNull(), is_object).alias("is_object")]
        for i, field in enumerate(self.fields):
            parts.append(_variant_type(document, field).alias(f"type{i}"))
            if "integer" in self.types.get(field, ()):
                parts.append(_variant_value(document, field, "string").alias(f"number{i}"))
        return F.struct(*parts)

    def reason(self, facts: str) -> Column:
        """First violated rule given the facts of a document, NULL when there is none."""
        is_object = F.col(f"{facts}.is_object")
        result = F.when(is_object.isNull(), "not_json").when(~is_object, "type:$")
        place = {field: i for i, field in enumerate(self.fields)}
        for field in self.required:
            result = result.when(F.col(f"{facts}.type{place[field]}").isNull(), f"missing:{field}")
        for field, kinds in self.types.items():
            if not kinds:
                continue
            typed = F.col(f"{facts}.type{place[field]}")
            number = F.col(f"{facts}.number{place[field]}") if "integer" in kinds else F.lit("")
            fits = reduce(lambda a, b: a | b, (_type_test(k, typed, number) for k in kinds))
            result = result.when(typed.isNotNull() & ~fits, f"type:{field}")
        return result

    def values(self, document: str) -> dict[str, Column]:
        """Typed columns of the known fields (a lone scalar type, else text); of integers also the text."""
        out = {}
        for field in self.fields:
            solid = [k for k in self.types.get(field, ()) if k != "null"]
            spark_type = _SPARK_TYPES.get(solid[0], "string") if len(solid) == 1 else "string"
            out[field] = _variant_value(document, field, spark_type)
            if solid == ["integer"]:
                text = _variant_value(document, field, "string")
                out[TEXT_OF.format(field)] = F.regexp_replace(text, r"\.0*$", "")
        return out


def _path(field: str) -> str:
    quoted = field.replace("\\", "\\\\").replace("'", "\\'")
    return f"$[0][\"{quoted}\"]"


def _variant_value(document: str, field: str, spark_type: str) -> Column:
    return F.expr(f"try_variant_get({document}, '{_path(field)}', '{spark_type}')")


def _variant_type(document: str, field: str) -> Column:
    return F.schema_of_variant(_variant_value(document, field, "variant"))


def _paired(body: Column) -> Column:
    """Body and its check number parsed as one JSON array, NULL when that is not JSON.

    The JSON parser stops after the first value and would accept what trails behind it.  Text
    behind the document ends the pair early or shifts the check number, and either is noticed.
    """
    number = F.xxhash64(body).cast("string")
    return F.try_parse_json(F.concat(F.lit("["), body, F.lit(","), number, F.lit("]")))


def parse_body(messages: DataFrame, text: str, into: str) -> DataFrame:
    """Add the whole text as one JSON document (first of a pair), NULL for anything else."""
    whole = F.try_variant_get(F.col("__pair"), "$[1]", "bigint") == F.xxhash64(text)
    paired = evaluate_once(messages, "__pair", _paired(F.col(text)))
    return paired.withColumn(into, F.when(whole, F.col("__pair"))).drop("__pair")


def validate(
    messages: DataFrame, schema: dict | None, body: str = "body", fields: dict[str, str] | None = None
) -> DataFrame:
    """Check the bodies and read their fields.

    Adds ``disposition`` (``ack`` means fit to be handled), ``reason`` and one column per
    known field (``fields`` maps JSON names to column names).  Without a schema nothing can
    be checked and the message goes back to its queue.
    """
    if schema is None:
        return messages.withColumns(
            {"disposition": F.lit(REQUEUE), "reason": F.lit("no_schema")}
        )
    check = MessageCheck.compile(schema)
    rename = fields or {}
    binary = isinstance(messages.schema[body].dataType, T.BinaryType)
    text = F.col(body).cast("string")
    decoded = F.when(F.is_valid_utf8(text), text) if binary else text
    documents = parse_body(messages.withColumn("__text", decoded), "__text", "__doc")
    parsed = evaluate_once(documents, "__facts", check.facts("__doc", "__text"))
    undecodable = F.col("__text").isNull() & F.col(body).isNotNull()
    judged = parsed.withColumn(
        "reason",
        F.when(undecodable, "not_utf8").otherwise(check.reason("__facts")),
    )
    values = {
        rename.get(field, field.replace("-", "_")): value
        for field, value in check.values("__doc").items()
    }
    return (
        judged.withColumns(values)
        .withColumn("disposition", F.when(F.col("reason").isNull(), ACK).otherwise(DEAD_LETTER))
        .drop("__text", "__doc", "__facts")
    )


def check_size(messages: DataFrame, max_bytes: int, body: str = "body") -> DataFrame:
    """Outgoing messages too long for the broker are rejected instead of published."""
    too_long = F.octet_length(body) > max_bytes
    return messages.withColumns(
        {
            "disposition": F.when(too_long, DEAD_LETTER).otherwise(ACK),
            "reason": F.when(too_long, "body_too_long"),
        }
    )


# --- handlers ----------------------------------------------------------------------------


def _keep(valid: DataFrame) -> DataFrame:
    return valid


@dataclass(frozen=True)
class Handler:
    """What to do with the valid messages of one binding, a whole table at a time.

    ``transform`` receives the valid messages and returns them with, where it wants to,
    changed ``disposition`` (``ack``, ``requeue`` or ``dead_letter``) and ``reason`` and with
    ``outcome_key`` and ``outcome_body`` of a message to publish.  With ``sees_all`` it gets
    the rejected messages too and has to leave those alone (their fields are to be ignored);
    the messages are then read and parsed once instead of once per side.
    """

    name: str
    exchange: str
    pattern: str
    schema: dict | None
    transform: Callable[[DataFrame], DataFrame] = _keep
    sees_all: bool = False

    @property
    def binding(self) -> Binding:
        return Binding(self.exchange, self.pattern, self.name)


PROCESSED = ("handler", "disposition", "reason", "outcome_key", "outcome_body")


def process(
    messages: DataFrame,
    handlers: Sequence[Handler],
    hold: Callable[[DataFrame], DataFrame] = _keep,
) -> DataFrame:
    """Every message with the verdict of each handler it reaches.

    Messages no handler receives stay in the result as ``unrouted``.  The messages are read once:
    each row is repeated per handler it reaches, its body is parsed once and checked against
    that handler's schema.  Only handlers whose transform wants the valid messages alone
    read the checked rows again; ``hold`` is applied to these before, and a stream keeps its
    micro-batch there.
    """
    base = messages.columns
    names = [F.when(fits(h.binding), F.lit(h.name)) for h in handlers]
    reached = F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")
    tagged = messages.withColumn("handler", F.explode_outer(reached))
    judged = _judge(tagged, handlers)
    apart = [h for h in handlers if h.transform is not _keep and h.schema is not None and not h.sees_all]
    for handler in handlers:
        if handler.sees_all and handler.transform is not _keep and handler.schema is not None:
            judged = _transformed(judged, handler)
    if not apart:
        return _verdicts(judged, base)
    judged = hold(judged)
    own = reduce(lambda a, b: a | b, (F.col("handler") == h.name for h in apart))
    fit = F.coalesce(own & (F.col("disposition") == ACK), F.lit(False))
    parts = [_verdicts(judged.where(~fit), base)]
    for handler in apart:
        valid = judged.where((F.col("handler") == handler.name) & (F.col("disposition") == ACK))
        parts.append(_verdicts(handler.transform(valid.withColumns(_values(handler))), base))
    return reduce(DataFrame.unionByName, parts)


_STATE = ("disposition", "reason", "outcome_key", "outcome_body")


def _values(handler: Handler) -> dict[str, Column]:
    mine = F.col("handler") == handler.name
    values = MessageCheck.compile(handler.schema).values("__doc")
    return {field.replace("-", "_"): F.when(mine, value) for field, value in values.items()}


def _judge(tagged: DataFrame, handlers: Sequence[Handler]) -> DataFrame:
    """Verdict of the schema of each row's handler; keeps the parsed body in ``__doc``."""
    checked = [h for h in handlers if h.schema is not None]
    text = F.col("body").cast("string")
    if isinstance(tagged.schema["body"].dataType, T.BinaryType):
        text = F.when(F.is_valid_utf8(text), text)
    parsed = parse_body(tagged.withColumn("__text", F.when(F.col("handler").isin([h.name for h in checked]), text)), "__text", "__doc")
    reason = F.when(F.col("handler").isNull(), "no_binding")
    for i, handler in enumerate(handlers):
        mine = F.col("handler") == handler.name
        if handler.schema is None:
            reason = reason.when(mine, "no_schema")
            continue
        check = MessageCheck.compile(handler.schema)
        parsed = evaluate_once(parsed, f"__facts{i}", F.when(mine, check.facts("__doc", "__text")))
        reason = reason.when(mine & F.col("__text").isNull() & F.col("body").isNotNull(), "not_utf8")
        reason = reason.when(mine, check.reason(f"__facts{i}"))
    blind = [h.name for h in handlers if h.schema is None]
    disposition = F.when(F.col("handler").isNull(), UNROUTED).when(F.col("handler").isin(blind), REQUEUE)
    none = F.lit(None).cast("string")
    return parsed.withColumn("reason", reason).withColumns(
        {
            "disposition": disposition.when(F.col("reason").isNull(), ACK).otherwise(DEAD_LETTER),
            "outcome_key": none,
            "outcome_body": none,
        }
    )


def _transformed(judged: DataFrame, handler: Handler) -> DataFrame:
    """Apply a transform to the rows of its handler; the rows of others look rejected to it and stay as they are."""
    mine = F.coalesce(F.col("handler") == handler.name, F.lit(False))
    columns = judged.columns
    held = judged.withColumns({f"__held_{c}": F.col(c) for c in _STATE})
    masked = held.withColumn("disposition", F.when(mine, F.col("disposition"))).withColumns(_values(handler))
    done = handler.transform(masked)
    return done.withColumns(
        {c: F.when(mine, F.col(c)).otherwise(F.col(f"__held_{c}")) for c in _STATE}
    ).select(*columns)


def _verdicts(df: DataFrame, base: Sequence[str]) -> DataFrame:
    absent = {c: F.lit(None).cast("string") for c in PROCESSED if c not in df.columns}
    return df.withColumns(absent).select(*base, *PROCESSED)
