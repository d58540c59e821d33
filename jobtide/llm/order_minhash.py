"""Order min-hash fingerprints: likeness in the sense of edit distance.

A text is seen as its k-mers (``K`` code points), each numbered by how often it has occurred before, so
repeats count.  For each of ``SKETCHES`` hash functions the ``PICKED`` numbered k-mers with the smallest
hashes are selected, put back into the order of the text and hashed as a tuple.  Two texts agree in a
sketch only if they share these k-mers *in the same order*; the share of agreeing sketches is their likeness.

The fingerprint is text: eight hexadecimal digits per sketch.

Results for odd input: null or empty text has the fingerprint of no k-mers, like any other empty text
(likeness 1); a text shorter than ``K`` is one k-mer; a text with fewer than ``PICKED`` k-mers uses all.  Next
documents go by ascending doc_id, null ids first, repeated ids by text; a single row is its own next one.
An empty table gives an empty table; extra columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.functions import pandas_udf

K = 8
SKETCHES = 48
PICKED = 2
RANGES_PER_PARTITION = 3
_RANDOM = np.random.default_rng(31337)
_FACTORS = (_RANDOM.integers(0, 2**31, SKETCHES, np.uint64) * np.uint64(2) + np.uint64(1)).astype(np.uint32)
_SHIFTS = _RANDOM.integers(0, 2**32, SKETCHES, np.uint64).astype(np.uint32)
_AGAIN = np.uint64(0x9E3779B97F4A7C15)
_CHARS = _RANDOM.integers(0, 2**63, K, np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def numbered_kmers(text: str) -> np.ndarray:
    """32-bit hash of each k-mer with its occurrence number, in text order."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    width = min(K, len(points))
    count = len(points) - width + 1 if len(points) else 0
    if not count:
        return np.empty(0, np.uint32)
    total = np.full(count, width, np.uint64)
    for i in range(width):
        total += (points[i : i + count] + np.uint64(1)) * _CHARS[i]
    hashes = _mixed(total)
    # hash and place in one number: a plain sort puts equal k-mers together, in text order
    bits = max(1, int(count).bit_length())
    if bits <= 22:
        together = np.sort((hashes >> np.uint64(bits) << np.uint64(bits)) | np.arange(count, dtype=np.uint64))
        order = (together & np.uint64((1 << bits) - 1)).astype(np.int64)
        same = together >> np.uint64(bits)
    else:
        order = np.argsort(hashes, kind="stable")
        same = hashes[order]
    new = np.ones(count, bool)
    new[1:] = same[1:] != same[:-1]
    if not new.all():
        places = np.arange(count)
        occurrence = places - np.maximum.accumulate(np.where(new, places, 0))
        # first occurrences keep their hash, so they agree with those of texts without any repeat
        again = np.flatnonzero(occurrence)
        hashes[order[again]] = _mixed(hashes[order[again]] + occurrence[again].astype(np.uint64) * _AGAIN)
    return (hashes >> np.uint64(32)).astype(np.uint32)


def sketches(text: str) -> np.ndarray:
    """One 32-bit hash per sketch."""
    kmers = numbered_kmers(text)
    made = np.zeros(SKETCHES, np.uint64)
    if len(kmers) <= PICKED:
        for value in kmers:
            made = _mixed(made * np.uint64(31) + value + np.arange(1, SKETCHES + 1, dtype=np.uint64))
        return (made >> np.uint64(32)).astype(np.uint32)
    hashed = np.empty_like(kmers)
    for s in range(SKETCHES):
        np.bitwise_xor(kmers, _SHIFTS[s], out=hashed)
        np.multiply(hashed, _FACTORS[s], out=hashed)
        places = []
        for _ in range(PICKED):
            at = int(hashed.argmin())
            places.append(at)
            hashed[at] = 0xFFFFFFFF
        value = s + 1
        for at in sorted(places):
            value = ((value ^ int(kmers[at])) * 0x9E3779B97F4A7C15 + 0x7F4A7C15) & 0xFFFFFFFFFFFFFFFF
            value ^= value >> 29
        made[s] = value
    return (_mixed(made) >> np.uint64(32)).astype(np.uint32)


def _fingerprints(texts: pd.Series) -> pd.Series:
    return texts.map(lambda text: sketches(text).astype(">u4").tobytes().hex())


def fingerprint(text: Column) -> Column:
    return pandas_udf(_fingerprints, "string")(F.coalesce(text, F.lit("")))


def likeness(a: Column, b: Column) -> Column:
    """Share of sketches in which two fingerprints agree."""
    same = F.transform(F.sequence(F.lit(0), F.lit(SKETCHES - 1)), lambda i: (F.substring(a, i * 8 + 1, 8) == F.substring(b, i * 8 + 1, 8)).cast("int"))
    return F.aggregate(same, F.lit(0), lambda total, x: total + x) / F.lit(float(SKETCHES))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text (null as empty) and fingerprint of every document."""
    whole = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return whole.withColumn("fingerprint", fingerprint(F.col("text")))


def _range_of(doc_id: Column, bounds: list[int]) -> Column:
    """Number of bounds at or below the id; null ids lie before all bounds."""
    limits = np.array(bounds, np.int64)

    @pandas_udf("int")
    def place(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(limits, ids.to_numpy(np.int64), side="right").astype(np.int32))

    return place(F.coalesce(doc_id.cast("bigint"), F.lit(-(2**63))))


def with_next(prints: DataFrame) -> DataFrame:
    """Adds ``next_text`` and ``next_fingerprint``, those of the next document by ascending doc_id.

    The ids are cut into ranges of about equal row counts; each range is put in order by itself, with a
    copy of the next range's first row at its end (of the first range's at the end of the last).  Texts
    are shuffled once.  The driver sees one id per range; their number is a multiple of the number
    of shuffle partitions.
    """
    ranges = RANGES_PER_PARTITION * int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / ranges for i in range(1, ranges)]
    bounds = sorted(set(prints.agg(F.percentile_approx("doc_id", shares, 20 * ranges)).first()[0] or []))
    ids = prints.select("doc_id").withColumn("range", _range_of(F.col("doc_id"), bounds))
    held = ids.groupBy("range").agg(F.min("doc_id").alias("least"), F.max(F.col("doc_id").isNull()).alias("nulls")).collect()
    if not held:
        return prints.withColumn("next_text", F.lit("")).withColumn("next_fingerprint", F.lit(""))
    held = sorted((r["range"], None if r["nulls"] else r["least"]) for r in held)
    before = [0] * (len(bounds) + 1)
    for i, (number, _) in enumerate(held):
        before[number] = held[i - 1][0]
    first = F.col("doc_id").isin([least for _, least in held if least is not None])
    if held[0][1] is None:
        first = F.coalesce(first, F.lit(False)) | F.col("doc_id").isNull()
    placed = prints.withColumn("range", _range_of(F.col("doc_id"), bounds)).withColumn("copy", F.lit(False))
    copies = prints.where(first).withColumn("range", _range_of(F.col("doc_id"), bounds))
    copies = copies.withColumn("range", F.element_at(F.lit(before), F.col("range") + 1)).withColumn("copy", F.lit(True))
    order = Window.partitionBy("range").orderBy("copy", F.col("doc_id").asc_nulls_first(), "text")
    following = placed.unionByName(copies).select(
        "doc_id", "text", "fingerprint", "copy", F.lead("text").over(order).alias("next_text"), F.lead("fingerprint").over(order).alias("next_fingerprint")
    )
    return following.where("NOT copy").drop("copy")


def edited(text: Column, following: Column) -> Column:
    """The text with its last half (rounded down) replaced by as many first characters of the next one."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - half), F.substring(following, F.lit(1), half))


def report(docs: DataFrame) -> DataFrame:
    """Fingerprints of the whole texts and of their edited forms, and how alike they are."""
    pairs = with_next(fingerprints(docs)).withColumn("edited", edited(F.col("text"), F.col("next_text")))
    both = pairs.withColumn("edited_fingerprint", fingerprint(F.col("edited")))
    return both.select(
        "doc_id",
        F.char_length("text").cast("bigint").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
