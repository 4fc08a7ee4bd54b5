"""Joins of a large table to a dimension with one row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def attach(
    df: DataFrame,
    dimension: DataFrame,
    key: str,
    on: Column | None = None,
    how: str = "left",
    split_hot: bool = True,
) -> DataFrame:
    """``df`` joined to ``dimension`` on ``key``, or on ``on`` equal to the dimension's key.

    No hint is given: Catalyst broadcasts the dimension when its size allows and otherwise
    sorts and merges, where the adaptive planner splits the hot keys of ``df``. It can do so
    only if the join shuffles both sides itself. A deduplicated dimension is already
    partitioned by its key and would be taken as it lies, so its key is restated as an
    expression; that costs one shuffle of the dimension, and none when it is broadcast.
    ``split_hot=False`` leaves the key as it is: Catalyst then knows it to be unique and drops
    the join where none of the dimension's columns is used, as in a count.
    """
    side = dimension.withColumn(key, F.coalesce(F.col(key), F.col(key))) if split_hot else dimension
    if on is None:
        return df.join(side, key, how)
    return df.join(side, on == side[key], how).drop(side[key])
