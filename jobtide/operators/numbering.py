"""Row numbers within a key that never gather a whole key in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

# About a million serial numbers per slice.
DEFAULT_SLICE = 1 << 20
# Slices of one group; serials of 64 bits make at most a few million groups of them.
SLICES_PER_GROUP = 1 << 22


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, where NULL equals NULL; the right side's keys are dropped."""
    renamed = right.withColumnsRenamed({k: f"__right_{k}" for k in keys})
    equal = reduce(lambda a, b: a & b, (left[k].eqNullSafe(renamed[f"__right_{k}"]) for k in keys))
    return left.join(renamed, equal, how).drop(*[f"__right_{k}" for k in keys])


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    slice_by: Column,
    into: str,
    first: int = 0,
    per_key: DataFrame | None = None,
) -> DataFrame:
    """Number the rows of each key in ``order``, starting at ``first``.

    ``slice_by`` cuts the order into consecutive slices (a whole number that must not fall while
    the order rises).  Rows are numbered inside their (key, slice); the rows of earlier slices are
    added from a table with one count per (key, slice).  That table is summed up in two levels,
    inside groups of neighbouring slices and over these groups, so a key that holds a large part of all rows is
    spread over its slices even where serials are so sparse that a slice is a single row.
    ``per_key`` (one row per key) is joined to the small table, which brings its columns to
    every row without a join on the bare key.  NULL keys count as one key.  The order must be total.
    """
    parts, groups = [*keys, "__slice"], [*keys, "__group"]
    sliced = df.withColumn("__slice", slice_by)
    inner = W.partitionBy(*parts).orderBy(*order)

    def earlier(partition: Sequence[str], by: str) -> W:
        return W.partitionBy(*partition).orderBy(by).rowsBetween(W.unboundedPreceding, -1)

    counts = sliced.groupBy(*parts).agg(F.count(F.lit(1)).alias("__rows"))
    counts = counts.withColumn("__group", F.floor(F.col("__slice") / F.lit(SLICES_PER_GROUP)))
    totals = (
        counts.groupBy(*groups)
        .agg(F.sum("__rows").alias("__rows"))
        .withColumn("__before_group", F.coalesce(F.sum("__rows").over(earlier(keys, "__group")), F.lit(0)))
        .drop("__rows")
    )
    if per_key is not None:
        totals = _same(totals, per_key, keys, "left")
    inside = counts.withColumn("__inside", F.coalesce(F.sum("__rows").over(earlier(groups, "__slice")), F.lit(0)))
    shifts = (
        _same(inside, totals, groups)
        .withColumn("__before", F.col("__before_group") + F.col("__inside"))
        .drop("__rows", "__group", "__before_group", "__inside")
    )
    return (
        _same(sliced.withColumn("__inner", F.row_number().over(inner)), shifts, parts)
        .withColumn(into, F.col("__before") + F.col("__inner") + F.lit(first - 1))
        .drop("__slice", "__before", "__inner")
    )


def serial_slice(serial: str, width: int = DEFAULT_SLICE) -> Column:
    """Slice number of a rising whole-number column."""
    return F.floor(F.col(serial) / F.lit(width))
