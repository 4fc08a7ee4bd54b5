"""Duplicate removal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_one(df: DataFrame, keys: Sequence[str], prefer: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the largest by ``prefer``, then by every other column, nulls last.

    The order is total, so the winner does not depend on partitioning. It is an aggregation
    rather than a window for two reasons: each map task sends at most one row per key, so a
    hot key is never gathered in one place; and Catalyst then knows the key is unique and
    drops a left join to this frame when none of its columns is used. The price: the largest
    struct is found by sorting, before the shuffle and after it, and where nearly every key is
    unique the first sort removes nothing.
    """
    columns = df.columns
    first = list(prefer or [])
    ranked = first + [c for c in columns if c not in keys and c not in first]
    if not ranked:
        return df.distinct()
    return (
        df.groupBy(*keys)
        .agg(F.max(F.struct(*ranked)).alias("_kept"))
        .select(*[c if c in keys else f"_kept.{c}" for c in columns])
    )


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()
