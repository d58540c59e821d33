"""Evaluate a costly expression once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def evaluate_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column whose expression is not copied into later filters and projections.

    The optimizer moves filters below projections by copying the expressions they refer to;
    for a parsed document that means parsing it once per reference.  The output of a
    generator is never copied, and a generator over a one-element array is one pass without
    a shuffle inside the same code-generated stage.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))
