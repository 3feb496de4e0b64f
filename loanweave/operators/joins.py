"""Joins that stay splittable when a key is hot."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame

from loanweave.session import stage


def join_aggregate(rows: DataFrame, aggregate: DataFrame, on: Column, how: str = "inner",
                   staged: Callable[[DataFrame, str], DataFrame] = stage, label: str = "aggregate") -> DataFrame:
    """Join ``rows`` with an aggregate that holds one row per key.

    AQE splits a skewed partition only where the join reads its shuffle
    directly.  An aggregate right above that shuffle (its own, reused for the
    join) forbids it, and one hot key then lands in one task.  Here the
    aggregate is written and read back, so the join's inputs are scans: the
    side with a hot key is dealt over many tasks, the aggregate's one row per
    key is repeated to them.  Meant for keys that may be hot; ``rows`` should
    itself have no aggregate above its shuffle.
    """
    return rows.join(staged(aggregate, label), on, how)
