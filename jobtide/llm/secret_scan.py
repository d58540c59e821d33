"""Secret scan: keyword automaton, anchored patterns near its hits, embedded checksums.

One pass of an Aho-Corasick automaton over a text finds the places where a secret can begin.
Patterns run only there, anchored at the hit, so prose costs one linear pass.  Tokens that carry
a checksum of their own count only when it holds.

The automaton knows the words of the assignment pattern, ``AKIA``, the prefixes of tokens with a
checksum, and every word of four hexadecimal digits (a run of 16 digits begins with one).  No word
of a kind lies inside another of the same kind, so hits come in order of their start; a hit inside
the previous match of its kind is passed over.  That gives the leftmost, non-overlapping matches
of the whole text, as a search from the left would.

Results for odd input: a null or empty text holds no secret (empty span list); repeated rows are
scanned each; an empty table gives an empty table; extra columns of any name are not looked at.
"""

from __future__ import annotations

import re
import zlib
from functools import lru_cache
from itertools import product

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

KINDS = ("assign", "access", "hex", "github", "npm")
BASE_KINDS = KINDS[:3]
SPAN_TYPE = "array<struct<kind:string,start:bigint,end:bigint>>"
MASK = "[REDACTED]"

LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 12, 18, 16
HEX_WORD = 4
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
# prefix, 30 random characters, 6 characters with their CRC-32 in base 62
CHECKED = {
    "github": (("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), re.compile(r"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")),
    "npm": (("npm_",), re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")),
}
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def checksum(secret: str) -> str:
    """CRC-32 of a token's random part as six digits in base 62."""
    value, digits = zlib.crc32(secret.encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits = BASE62[digit] + digits
    return digits


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    made = ahocorasick.Automaton()
    for digits in product("0123456789abcdef", repeat=HEX_WORD):
        made.add_word("".join(digits), ("hex", HEX_WORD))
    for word in ASSIGN_WORDS:
        made.add_word(word, ("assign", len(word)))
    made.add_word("akia", ("access", 4))
    for kind, (prefixes, _) in CHECKED.items():
        for prefix in prefixes:
            made.add_word(prefix, (kind, len(prefix)))
    made.make_automaton()
    return made


def _lowered(text: str) -> str:
    """Lower case with the same positions; only one letter grows when lowered."""
    lowered = text.lower()
    return lowered if len(lowered) == len(text) else text.replace("İ", "i").lower()


def scan(text: str) -> list[tuple[int, str, int]]:
    """All spans of a text as (start, kind, end), by start and then kind as listed."""
    found, past = [], dict.fromkeys(KINDS, 0)
    for last, (kind, size) in automaton().iter(_lowered(text)):
        start = last - size + 1
        if start < past[kind]:
            continue
        if kind == "hex":
            match, good = HEX.match(text, start), None
            good = match and match.end() - start >= LEAST_HEX
        elif kind == "assign":
            match = ASSIGN.match(text, start)
            good = match and match.end(2) - match.start(2) >= LEAST_VALUE
        elif kind == "access":
            match = ACCESS.match(text, start)
            good = match and match.end() - start >= LEAST_ACCESS
        else:
            match = CHECKED[kind][1].match(text, start)
            good = match and checksum(match[1]) == match[2]
        if match:
            past[kind] = match.end()
        if good:
            found.append((start, KINDS.index(kind), match.end()))
    return [(start, KINDS[kind], end) for start, kind, end in sorted(found)]


def _spans(texts: pd.Series) -> pd.Series:
    return texts.map(lambda text: [{"kind": k, "start": s, "end": e} for s, k, e in scan(text)] if text else [])


def _redacted(texts: pd.Series) -> pd.Series:
    def one(text):
        spans = scan(text) if text else []
        if not spans:
            return text
        parts, at = [], 0
        for start, _, end in spans:
            if start >= at:
                parts += [text[at:start], MASK]
            at = max(at, end)
        return "".join([*parts, text[at:]])

    return texts.map(one, na_action="ignore")


def secret_spans(text: Column) -> Column:
    """Spans of secrets: kind, start and end in code points, end exclusive."""
    return pandas_udf(_spans, SPAN_TYPE)(F.coalesce(text, F.lit("")))


def find_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its id and ``found``, the spans in order."""
    return docs.select(F.col(doc_id), secret_spans(F.col(text)).alias("found"))


def redact_secrets(docs: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The documents with each span (overlapping ones as one) replaced by a mask.

    A null text stays null.  ``n_chars`` is set anew where a text has changed.
    """
    columns = docs.columns
    masked = docs.withColumn("masked text", pandas_udf(_redacted, "string")(F.col(text)))
    changed = ~F.col("masked text").eqNullSafe(F.col(text))
    if n_chars in columns:
        length = F.char_length("masked text").cast(docs.schema[n_chars].dataType)
        masked = masked.withColumn(n_chars, F.when(changed, length).otherwise(F.col(n_chars)))
    return masked.withColumn(text, F.col("masked text")).select(*[f"`{c}`" for c in columns])


def span_text(spans: Column, kinds: tuple[str, ...] | None = None) -> Column:
    """Spans as ``kind:start:end``, comma-joined; of the given kinds only."""
    if kinds:
        spans = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def report(docs: DataFrame) -> DataFrame:
    """Counts by kind, the digest of the base spans, and all spans as text."""
    found = F.col("found")
    counts = [_count(found, kind).alias(f"n_{kind}") for kind in KINDS]
    return find_secrets(docs).select(
        "doc_id",
        *counts[:3],
        F.sha2(span_text(found, BASE_KINDS), 256).alias("base_sha256"),
        span_text(found).alias("spans"),
        *counts[3:],
    )
