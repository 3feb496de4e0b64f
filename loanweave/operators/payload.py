"""Unpacking JSON payload arrays into child rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanweave.functions.json import element_count, nth, parse_array, repaired_array, whole_array


def bind_array(df: DataFrame, name: str, payload: str, element_ddl: str) -> DataFrame:
    """``df`` with column ``name``: the payload parsed once per row.

    Two projections: the whole-array parse, then its repair, which parses
    elements only in rows where the first is NULL.  The optimizer keeps a
    projection whose expensive column is read more than once, so however
    often ``name`` is read, a text is parsed once."""
    return (df.withColumn(name, whole_array(payload, element_ddl))
              .withColumn(name, repaired_array(F.col(name), payload, element_ddl)))


def explode_elements(df: DataFrame, payload: str, element_ddl: str,
                     keep: Sequence[Column | str]) -> DataFrame:
    """One row per payload element (column ``e``); rows whose payload is
    NULL, empty or malformed are dropped.

    The parse stands inside the generator: over a bound column the optimizer
    would infer a ``size > 0`` filter and parse the text there once more."""
    return df.select(*keep, F.explode(parse_array(payload, element_ddl)).alias("e"))


def fan_out(df: DataFrame, payload: str) -> DataFrame:
    """Repeat each row once per top-level element of a JSON array column.

    Rows with a NULL / empty / non-array / malformed payload disappear, as
    with an inner explode of the parsed array; only the multiplicity is
    produced, the elements are never materialised.
    """
    return df.withColumn(
        "_copy", F.explode(F.array_repeat(F.lit(True), element_count(payload)))
    ).drop("_copy")


def values_at(parsed: Column, fields: Sequence[tuple[str, str]], index: int) -> list[Column]:
    """``(out_name, path)`` fields of element ``index`` of a parsed array;
    NULL when the array is shorter or NULL (no ANSI index error)."""
    elem = nth(parsed, index)
    out = []
    for name, path in fields:
        c = elem
        for part in path.split("."):
            c = c[part]
        out.append(c.alias(name))
    return out
