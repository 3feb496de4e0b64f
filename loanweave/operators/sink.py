"""Writing mart tables: dated, overwrite-per-date, no single-file funnel."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Most bytes of rows, uncompressed, that go into one output file.
FILE_BYTES = 256 * 1024 * 1024
#: Bytes taken for a text (a hash key in hex is this long) and a row's own.
_TEXT_BYTES, _ROW_BYTES = 64, 8


def _wall_clock(ts: dt.datetime) -> Column:
    """A timestamp_ntz literal of the given wall-clock time (aware values are
    taken in UTC); built from text so no process or session zone shifts it."""
    if ts.tzinfo is not None:
        ts = ts.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return F.lit(ts.isoformat(sep=" ")).cast("timestamp_ntz")


def stamp(df: DataFrame, as_of: dt.datetime | None = None) -> DataFrame:
    """Add ``extract_timestamp`` (a parameter, so reruns are reproducible)."""
    ts = _wall_clock(as_of) if as_of else F.localtimestamp()
    return df.withColumn("extract_timestamp", ts)


def _width(kind: T.DataType) -> int:
    """Bytes of an average value of a type."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return _TEXT_BYTES
    if isinstance(kind, T.ArrayType):
        return 4 * _width(kind.elementType)
    if isinstance(kind, T.MapType):
        return 4 * (_width(kind.keyType) + _width(kind.valueType))
    if isinstance(kind, T.StructType):
        return sum(_width(f.dataType) for f in kind.fields)
    if isinstance(kind, T.DecimalType):
        return 16 if kind.precision > 18 else 8
    return {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "date": 4, "float": 4, "void": 1}.get(kind.simpleString(), 8)


def rows_per_file(schema: T.StructType, file_bytes: int = FILE_BYTES) -> int:
    """Rows that fill a file of ``file_bytes``, from the width of a row."""
    return max(1, file_bytes // (_ROW_BYTES + _width(schema)))


def write_sized(df: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> T.StructType:
    """Write ``df`` to the folder ``path`` in files of a bounded size and not in a swarm of
    small ones; returns the schema.

    Tasks that end in a shuffle are already coalesced and split by AQE.  Where the
    plan has none, a task writes what its scan split yields, tiny after a
    filter and large after a fan-out; ``rebalance`` then lets AQE even that out by
    measured bytes.  Rows per file follow from the width of a row.
    """
    plan = df._jdf.queryExecution().executedPlan().toString()
    even = df if "Exchange" in plan else df.hint("rebalance")
    (even.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file(df.schema, file_bytes)).parquet(path))
    return df.schema


def write_table(df: DataFrame, root: str, table: str, extract_date: dt.date,
                as_of: dt.datetime | None = None) -> str:
    """Write ``root/table/extract_date=D`` and return ``root/table``.

    For single reports; tables that belong together go through
    :class:`loanweave.operators.publish.Publication`.

    The date's directory is overwritten as a whole, so a rerun replaces that
    date exactly, also when it now has no rows; other dates stay.  Readers of
    ``root/table`` get ``extract_date`` back by partition discovery.
    """
    out = f"{root.rstrip('/')}/{table}"
    write_sized(stamp(df, as_of), f"{out}/extract_date={extract_date.isoformat()}")
    return out
