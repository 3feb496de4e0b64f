"""All tables of a date published at once.

A run writes every table into a folder of its own, ``<root>/<table>/run=R/
extract_date=D``, which no reader looks at.  The run's last act is one small
manifest, ``<root>/_manifests/extract_date=D/<number>.json``, that names the
folders; it appears whole or not at all, and the highest number of a date is
the one that counts.  So readers see either all tables of the old run or all
of the new one, whenever a driver or executor dies, and a reader that has
resolved its paths keeps them while newer runs are published.
"""

from __future__ import annotations

import datetime as dt
import json
import threading
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanweave.operators import sink
from loanweave.sources import files

MANIFESTS = "_manifests"
_MANIFEST_DDL = ("number int, run string, as_of string, tables array<struct<name string, path string, "
                 "schema string, files bigint, bytes bigint>>")


class NotPublished(LookupError):
    """No committed run holds the table."""


class Publication:
    """One run of one date: ``write`` tables (from any thread), then ``commit``.

    As a context manager it commits when the block ends well; otherwise the
    run's folders are removed and nothing changes for readers."""

    def __init__(self, spark: SparkSession, root: str, extract_date: dt.date, as_of: dt.datetime | None = None):
        self.spark, self.root, self.date, self.as_of = spark, root.rstrip("/"), extract_date, as_of
        self.run = uuid.uuid4().hex
        self._tables: dict[str, dict] = {}
        self._started: set[str] = set()
        self._lock = threading.Lock()

    def folder(self, table: str) -> str:
        return f"{self.root}/{table}/run={self.run}"

    def write(self, df: DataFrame, table: str) -> str:
        """Write one table of this run; returns its folder, which no reader sees yet."""
        path = self.folder(table)
        self._started.add(table)
        leaf = f"{path}/extract_date={self.date.isoformat()}"
        schema = sink.write_sized(sink.stamp(df, self.as_of), leaf)
        sizes = files.data_files(self.spark, leaf)
        with self._lock:
            self._tables[table] = {"name": table, "path": path, "schema": schema.json(), "files": len(sizes), "bytes": sum(sizes)}
        return path

    def commit(self) -> str:
        """Publish the written tables as the date's only ones; returns the manifest's path.
        Two runs of a date that end at once both appear, one after the other."""
        folder = f"{self.root}/{MANIFESTS}/extract_date={self.date.isoformat()}"
        while True:
            taken = [int(name.split(".")[0]) for name, _ in files.children(self.spark, folder) if name.endswith(".json") and name[0] != "."]
            number = max(taken, default=0) + 1
            text = json.dumps({"number": number, "run": self.run, "as_of": str(self.as_of or ""),
                               "tables": [self._tables[k] for k in sorted(self._tables)]})
            path = f"{folder}/{number:08d}.json"
            if files.write_new(self.spark, path, text):
                return path

    def discard(self) -> None:
        for table in sorted(self._started):
            files.delete(self.spark, self.folder(table))

    def __enter__(self) -> "Publication":
        return self

    def __exit__(self, kind, value, trace) -> None:
        if kind is None:
            self.commit()
        else:
            self.discard()


def manifests(spark: SparkSession, root: str) -> DataFrame:
    """(extract_date, number, run, as_of, tables): the manifest that counts of each date."""
    folder = f"{root.rstrip('/')}/{MANIFESTS}"
    if not files.exists(spark, folder):
        return spark.createDataFrame([], f"{_MANIFEST_DDL}, extract_date date")
    newest = Window.partitionBy("extract_date").orderBy(F.desc("number"))
    read = spark.read.schema(f"{_MANIFEST_DDL}, extract_date date").json(folder)
    return read.withColumn("rn", F.row_number().over(newest)).where("rn = 1").drop("rn")


def published_folders(spark: SparkSession, root: str, table: str, dates: Sequence[dt.date] | None = None) -> list[tuple[dt.date, str, str]]:
    """(date, folder, schema) of a table's committed runs, one per date."""
    found = manifests(spark, root).select("extract_date", F.inline("tables")).where(F.col("name") == table)
    if dates is not None:
        found = found.where(F.col("extract_date").isin(list(dates)))
    return sorted((r["extract_date"], r["path"], r["schema"]) for r in found.select("extract_date", "path", "schema").collect())


def read_published(spark: SparkSession, root: str, table: str, dates: Sequence[dt.date] | None = None) -> DataFrame:
    """A table's committed rows of all or the given dates, with ``extract_date``.
    Columns are those of the latest date; an older run without one gives NULLs."""
    found = published_folders(spark, root, table, dates)
    if not found:
        raise NotPublished(f"{table} has no committed run under {root}")
    schema = T.StructType.fromJson(json.loads(found[-1][2]))
    leaves = [f"{path}/extract_date={day.isoformat()}" for day, path, _ in found]
    whole = T.StructType([*schema.fields, T.StructField("run", T.StringType()), T.StructField("extract_date", T.DateType())])
    return spark.read.schema(whole).option("basePath", f"{root.rstrip('/')}/{table}").parquet(*leaves).drop("run")


def remove_unpublished(spark: SparkSession, root: str, older_than: dt.timedelta = dt.timedelta(days=7)) -> list[str]:
    """Delete run folders that no counting manifest names and that were written
    before ``older_than`` ago (a younger one may belong to a run under way, or to
    a reader that resolved its paths a moment ago); returns them."""
    root = root.rstrip("/")
    named = {r["path"] for r in manifests(spark, root).select(F.inline("tables")).select("path").collect()}
    limit = (time.time() - older_than.total_seconds()) * 1000
    gone = []
    for table, _ in files.children(spark, root):
        if table.startswith(("_", ".")):
            continue
        for run, written in files.children(spark, f"{root}/{table}"):
            path = f"{root}/{table}/{run}"
            if run.startswith("run=") and path not in named and written < limit:
                files.delete(spark, path)
                gone.append(path)
    return gone
