"""Equi-join of a table with hot keys and a table with few rows per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

HOT_SHARE = 0.001
SPREAD = 64


def hot_keys(df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE) -> list[int]:
    """Hashes of the keys that hold more than ``share`` of all rows: at most ``1/share``.

    One pass over the key columns with a frequent-items sketch, merged per task: the keys
    themselves are not shuffled.  The sketch is ten times as large as the list, which makes
    its error smaller than the share looked for.
    """
    most = max(1, round(1 / share))
    sketch = F.expr(f"approx_top_k(__key, {most}, {10 * most})").alias("top")
    row = (
        df.select(F.xxhash64(*keys).alias("__key"))
        .agg(F.count(F.lit(1)).alias("rows"), sketch)
        .first()
    )
    limit = row["rows"] * share
    return sorted(entry["item"] for entry in (row["top"] or []) if entry["count"] > limit)


def skew_join(
    big: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    hot: Sequence[int] | None = None,
    spread: int = SPREAD,
    salt_by: Sequence[str] | None = None,
) -> DataFrame:
    """Join in which each hot key of ``big`` is dealt out over ``spread`` tasks.

    ``hot`` is the list that ``hot_keys`` gives, found once per source and used for all joins
    with it.  Without one it is an ordinary join, whose skewed partitions adaptive execution splits.
    The rows of ``small`` with a hot key are repeated once per salt value, all others stay
    single.  The list becomes part of both sides' expressions, so they agree whatever is
    computed again later; which keys are on it decides about the distribution only, never about the
    result.  The salt is a hash of ``salt_by`` (by default of the whole row).  ``how`` is
    ``inner`` or ``left``.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type: {how}")
    keys = list(keys)
    for key in keys:
        kind = big.schema[key].dataType
        # both sides hash the key: equal values must have equal bytes
        if small.schema[key].dataType != kind or isinstance(kind, (T.FloatType, T.DoubleType)):
            raise ValueError(f"key {key} must have one exact type on both sides")
    if not hot:
        return big.join(small, keys, how)

    def when_hot(value: Column, other: Column) -> Column:
        return F.when(F.xxhash64(*keys).isin(hot), value).otherwise(other)

    # taken from the row itself: a task that runs again deals its rows out the same way
    spot = F.pmod(F.xxhash64(*(salt_by or big.columns)), F.lit(spread)).cast("int")
    salts = when_hot(F.sequence(F.lit(0), F.lit(spread - 1)), F.array(F.lit(0)))
    left = big.withColumn("__salt", when_hot(spot, F.lit(0)))
    right = small.withColumn("__salt", F.explode(salts))
    return left.join(right, [*keys, "__salt"], how).drop("__salt")
