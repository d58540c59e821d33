"""Metadata documents: XSD check and name/value pairs."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from jobtide.operators.once import evaluate_once

SCHEMA_FILE = Path(__file__).resolve().parent.parent / "schemas" / "metadata.xsd"

_CORRUPT = "_corrupt_record"
_PAIR = T.StructType(
    [T.StructField("_name", T.StringType()), T.StructField("_value", T.StringType())]
)
# parts of the movie information that carry a token list
MOVIE_PARTS = ("meta-movie", "meta-track", "meta-video-track", "meta-audio-track", "meta-hint-track")
_TOKENS = T.StructType([T.StructField("_tokens", T.StringType())])
DOCUMENT = T.StructType(
    [
        T.StructField("meta-movie-info", T.StructType([T.StructField(part, _TOKENS) for part in MOVIE_PARTS])),
        T.StructField(
            "meta-group",
            T.StructType(
                [
                    T.StructField("_type", T.StringType()),
                    T.StructField("meta", T.ArrayType(_PAIR)),
                ]
            ),
        ),
        T.StructField(_CORRUPT, T.StringType()),
    ]
)


def _plain_document() -> str:
    """Regular expression of the documents that are valid beyond doubt.

    The schema has three levels and no recursion, so without comments, sections, processing
    instructions, namespaces and unusual entities a valid document is one fixed sequence of
    tags.  All repetitions are possessive: matching takes linear time and constant stack.
    """
    gap, must = r"[ \t\r\n]*+", r"[ \t\r\n]++"
    entity = r"&(?:amp|lt|gt|quot|apos|#9|#10|#13);"
    barred = r"<&\x00-\x08\x0b\x0c\x0e-\x1f\ufffe\uffff"

    def attribute(name: str) -> str:
        quoted = "|".join(rf"{q}[^{q}{barred}]*+(?:{entity}[^{q}{barred}]*+)*+{q}" for q in "\"'")
        return f"{must}{name}{gap}={gap}(?:{quoted})"

    def empty(tag: str, attributes: str) -> str:
        return f"<{tag}{attributes}{gap}(?:/>|></{tag}{gap}>)"

    def element(tag: str, attributes: str, content: str) -> str:
        return f"<{tag}{attributes}{gap}>{gap}{content}</{tag}{gap}>"

    name, value = attribute("name"), attribute("value")
    pair = empty("meta", f"(?:{name}{value}|{value}{name})")
    group = element("meta-group", f"(?:{attribute('type')})?+", f"(?:{pair}{gap})++")
    tokens = "".join(
        f"(?:{empty(tag, attribute('tokens'))}{gap})?+"
        for tag in MOVIE_PARTS
    )
    info = f"(?:<meta-movie-info{gap}/>|{element('meta-movie-info', '', tokens)})"
    version = rf"{must}version{gap}={gap}(?:\"1\.0\"|'1\.0')"
    return rf"\A(?:<\?xml{version}{gap}\?>)?+{gap}{element('meta-data', '', f'(?:{info}{gap})?+{group}{gap}')}{gap}\z"


def ship_schema(spark: SparkSession, xsd: str | Path = SCHEMA_FILE) -> str:
    """Send the XSD to all executors; the file name is what the parser looks it up by."""
    spark.sparkContext.addFile(str(xsd))
    return Path(xsd).name


def parse_metadata(df: DataFrame, column: str, xsd: str | Path = SCHEMA_FILE) -> DataFrame:
    """Add ``metadata_valid``, ``metadata_type``, ``metadata_pairs`` and ``movie_tokens`` from an XML column.

    ``movie_tokens`` maps each part of the movie information that is there to its token list.

    A document that is not well formed or does not fit the XSD is invalid, never an error.
    The XSD check of the parser builds a validator for every document, which costs several
    times as much as parsing.  For the built-in schema, documents of the plain form pass
    without it; all others, and all documents under another schema, take the full check.
    """
    plain = {
        "mode": "PERMISSIVE",
        "attributePrefix": "_",
        "valueTag": "__text",
        "columnNameOfCorruptRecord": _CORRUPT,
    }
    checked = {**plain, "rowValidationXSDPath": ship_schema(df.sparkSession, xsd)}
    document = F.from_xml(F.col(column), DOCUMENT, checked)
    if xsd == SCHEMA_FILE:
        simple = F.col(column).rlike(_plain_document())
        document = F.when(simple, F.from_xml(F.col(column), DOCUMENT, plain)).otherwise(document)
    parsed = evaluate_once(df, "__xml", document)
    group = F.col("__xml")["meta-group"]
    valid = F.col(column).isNotNull() & F.col("__xml")[_CORRUPT].isNull()
    return parsed.withColumns(
        {
            "metadata_valid": valid,
            "metadata_type": F.when(valid, group["_type"]),
            "metadata_pairs": F.when(
                valid,
                F.transform(
                    group["meta"],
                    lambda m: F.struct(m["_name"].alias("name"), m["_value"].alias("value")),
                ),
            ),
            "movie_tokens": F.when(valid, _movie_tokens(F.col("__xml")["meta-movie-info"])),
        }
    ).drop("__xml")


def _movie_tokens(info: Column) -> Column:
    entries = [F.struct(F.lit(part).alias("key"), info[part]["_tokens"].alias("value")) for part in MOVIE_PARTS]
    return F.map_from_entries(F.filter(F.array(*entries), lambda e: e["value"].isNotNull()))


def metadata_rows(parsed: DataFrame, *keys: str) -> DataFrame:
    """One row per pair of the valid documents."""
    return parsed.select(*keys, F.posexplode("metadata_pairs").alias("position", "pair")).select(
        *keys, "position", "pair.name", "pair.value"
    )


def metadata_value(name: str) -> Column:
    """Value of the first pair with that name, NULL when there is none."""
    named = F.filter(F.col("metadata_pairs"), lambda p: p["name"] == name)
    return F.get(named, F.lit(0))["value"]
