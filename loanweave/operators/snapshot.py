"""Row selection over a snapshot: visible rows, latest version per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def visible(df: DataFrame, flag: str = "dark") -> DataFrame:
    """Rows whose hidden flag is false; a NULL flag drops the row.
    Written as an equality so it is pushed into the parquet scan."""
    return df.filter(F.col(flag) == F.lit(False))


def latest_per_key(df: DataFrame, key: str | Sequence[str] = "loan_id",
                   order: Sequence[str] = ("published_at", "id")) -> DataFrame:
    """Newest row per key: ``order`` descending, NULLs last.

    The trailing order column breaks ties deterministically.  Catalyst plans
    this as a partial ``WindowGroupLimit`` before the exchange and a final one
    after it, so each map task forwards at most one row per key: a loan with
    a very large number of versions is reduced before the shuffle.
    """
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return (df.withColumn("_version_rank", F.row_number().over(w))
              .filter(F.col("_version_rank") == 1)
              .drop("_version_rank"))


def non_empty(df: DataFrame, payload: str) -> DataFrame:
    """Drop rows whose payload text is exactly ``'[]'`` (NULL is dropped too)."""
    return df.filter(F.col(payload) != F.lit("[]"))


def rename_by_mapping(df: DataFrame, old_names: str, new_names: str,
                      sep: str = "\r\n") -> DataFrame:
    """Rename columns by two separator-joined name lists; unmapped names pass
    through and names that are not columns are ignored."""
    mapping = dict(zip(old_names.split(sep), new_names.split(sep)))
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})
