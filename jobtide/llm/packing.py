"""Packing by powers of two: each document is cut into pieces of binary lengths.

A document of n ids (its text's ids and one id at its end) becomes n // 2048 pieces of 2048 and one
piece for each binary digit of the rest, longest first.  A sequence is one piece, so no sequence
crosses documents, every sequence length is a power of two, and nothing is padded; sequences of the
same length form a bucket from which batches are drawn.  The cut is arithmetic on the length, done
by SQL functions without a shuffle; only the encoding runs in Python.

``sequence_id`` is the place of the piece in its input partition, unique over the table; the same
input files give the same numbers.

Results for odd input: null or empty text has only the end id, one piece of length 1; repeated rows
and null ids are packed each; extra columns of any name are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from jobtide.llm.bpe import word_ids

SEQUENCE = 2048
END_ID = 1


def piece_list(length: Column, longest: int = SEQUENCE) -> Column:
    """Array of (start, length) of the pieces of a document with so many ids."""
    whole = F.floor(length / longest).cast("bigint")
    rest = length - whole * longest
    full = F.transform(
        F.when(whole > 0, F.sequence(F.lit(0).cast("bigint"), whole - 1)).otherwise(F.array().cast("array<bigint>")),
        lambda i: F.struct((i * longest).alias("start"), F.lit(longest).cast("bigint").alias("length")),
    )
    bits = F.array(*[F.lit(1 << bit).cast("bigint") for bit in reversed(range(longest.bit_length() - 1))])
    tail = F.transform(
        F.filter(bits, lambda size: rest.bitwiseAND(size) != 0),
        lambda size: F.struct((whole * longest + rest - rest % (size * 2)).alias("start"), size.alias("length")),
    )
    return F.concat(full, tail)


def pack(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", file: str | None = None, end_id: int = END_ID, longest: int = SEQUENCE
) -> DataFrame:
    """Pieces with their ids (binary, little-endian unsigned 32-bit): doc_id, start, length, doc_tokens, bucket, ids, sequence_id, offset.

    ``longest`` is a power of two.
    """
    if longest & (longest - 1):
        raise ValueError("the longest sequence must be a power of two")
    end = F.lit(bytearray(end_id.to_bytes(4, "little")))
    coded = docs.select(F.col(doc_id).alias("doc_id"), F.concat(word_ids(F.col(text), file), end).alias("all ids"))
    counted = coded.withColumn("doc_tokens", (F.octet_length("all ids") / 4).cast("bigint"))
    pieces = F.transform(
        piece_list(F.col("doc_tokens"), longest),
        lambda p: F.struct(
            p["start"], p["length"], F.substring(F.col("all ids"), (p["start"] * 4 + 1).cast("int"), (p["length"] * 4).cast("int")).alias("ids")
        ),
    )
    return (
        counted.select("doc_id", "doc_tokens", F.explode(pieces).alias("piece"))
        .select("doc_id", "piece.start", "piece.length", "doc_tokens", F.log2("piece.length").cast("int").alias("bucket"), "piece.ids")
        .withColumn("sequence_id", F.monotonically_increasing_id())
        .withColumn("offset", F.lit(0).cast("bigint"))
    )


def write_buckets(pieces: DataFrame, folder: str) -> None:
    """The sequences in one folder per length, for batches of equal lengths."""
    pieces.write.mode("overwrite").partitionBy("bucket").parquet(folder)


def report(docs: DataFrame) -> DataFrame:
    return pack(docs).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
