"""JSON payload expressions, all native (no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_object(c: Column | str, ddl: str) -> Column:
    """JSON object text -> struct (malformed -> NULL)."""
    return F.from_json(_c(c), ddl)


def whole_array(c: Column | str, element_ddl: str) -> Column:
    """JSON array text -> array<struct> in one parse; a lone object becomes a
    1-element array, an array with an element that is no object gives NULL."""
    return F.from_json(_c(c), f"array<struct<{element_ddl}>>")


def repaired_array(whole: Column, c: Column | str, element_ddl: str) -> Column:
    """``whole`` (of :func:`whole_array`) or, evaluated only in rows where that is
    NULL for an array text, the elements parsed one by one: an element that is no
    object becomes an all-NULL struct and leaves its siblings alone."""
    one_by_one = F.transform(F.from_json(_c(c), "array<string>"), lambda e: F.from_json(e, f"struct<{element_ddl}>"))
    return F.coalesce(whole, F.when(F.json_array_length(_c(c)).isNotNull(), one_by_one))


def parse_array(c: Column | str, element_ddl: str) -> Column:
    """JSON array text -> array<struct>, as one expression.

    ``element_ddl`` names the fields that are read and no others
    (:func:`loanweave.sources.contract.pick`): the optimizer cannot prune
    fields through the repair of mixed arrays.  Where the array is used more
    than once, bind it with :func:`loanweave.operators.payload.bind_array`."""
    return repaired_array(whole_array(c, element_ddl), c, element_ddl)


def array_elements(c: Column | str) -> Column:
    """JSON array text -> array of element texts (re-serialised); object -> NULL."""
    return F.from_json(_c(c), "array<string>")


def element_count(c: Column | str) -> Column:
    """Number of top-level elements of a JSON array text; NULL for objects,
    malformed text or NULL.  Same count as ``size(array_elements(c))``
    without materialising the element texts."""
    return F.json_array_length(_c(c))


def element_rows(c: Column | str) -> Column:
    """``size(parse_array(c))`` without building the structs: the elements of
    an array, 1 for a lone object, 0 for anything else."""
    c = _c(c)
    lone = F.when(F.json_object_keys(c).isNotNull(), F.lit(1)).otherwise(F.lit(0))
    return F.when(c.rlike(r"^\s*\{"), lone).otherwise(F.coalesce(F.json_array_length(c), F.lit(0)))


def array_or_object(c: Column | str) -> Column:
    """Array of element texts: an array gives its elements, an object gives
    itself, ``'[]'``/NULL/scalars/malformed give NULL."""
    c = _c(c)
    # Only a text that starts like an object is parsed as one.
    object_led = c.rlike(r"^\s*\{")
    return (F.when(c.isNull() | (c == "[]"), F.lit(None).cast("array<string>"))
             .when(object_led & F.json_object_keys(c).isNotNull(), F.array(c))
             .otherwise(array_elements(c)))


def nth(arr: Column, i: int) -> Column:
    """Element ``i`` (0-based) of an array, NULL when out of range or NULL."""
    return F.get(arr, i)


def first_event_date(events: Column, status: str) -> Column:
    """Earliest ``date`` text among events whose ``status`` equals ``status``.

    NULL when there is none, when the events are NULL, or when a matching
    event has no ``date`` (then no minimum is defined).  Text minimum, which
    orders ISO dates and timestamps correctly.
    """
    hits = F.filter(events, lambda e: e["status"] == F.lit(status))
    return (F.when(F.exists(hits, lambda e: e["date"].isNull()), F.lit(None).cast("string"))
             .otherwise(F.array_min(F.transform(hits, lambda e: e["date"]))))


def path_text(c: Column | str, field: str) -> Column:
    """``$.field`` as text (numbers and booleans as their JSON text)."""
    return F.get_json_object(_c(c), f"$.{field}")
