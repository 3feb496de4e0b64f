"""Deterministic surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_text(*parts: Column | str) -> Column:
    """The text that :func:`surrogate_key` hashes: equal texts have equal keys."""
    if len(parts) == 1:
        part = F.col(parts[0]) if isinstance(parts[0], str) else parts[0]
        return part.cast("string")
    return F.concat_ws("", *parts)


def surrogate_key(*parts: Column | str) -> Column:
    """SHA-256 hex of the parts joined with no separator; NULL parts are
    skipped, timestamps enter as their text, arrays are flattened.  A key of
    one part is that part's own hash, NULL for a NULL part."""
    return F.sha2(key_text(*parts).cast("binary"), 256)


def hash_concat(a: Column, b: Column) -> Column:
    """Two digests side by side; NULL if either is NULL."""
    return F.concat(a, b)
