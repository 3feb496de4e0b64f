"""A snapshot laid out so that ranking its versions needs no shuffle.

``write_layout`` deals the rows into buckets by loan, sorted by loan and newest
version first; the number of buckets follows from bytes.  A scan of the buckets
is already partitioned by loan, so the window that picks the latest version runs
where the data lies.  Loans with too many versions for one bucket stand apart,
spread by range over ordinary files; they are reduced per task before a small
shuffle, so no task reads a hot loan whole.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanweave.operators.snapshot import latest_per_key, visible
from loanweave.session import plan_size_bytes
from loanweave.sources import files

BUCKET_BYTES = 128 * 1024 * 1024
#: A layout is written in parts of about so many bytes of input files, and in so many at most,
#: so that a caller who drops each job's shuffle files holds those of one part at a time.
PART_BYTES = 128 * 1024 * 1024
MOST_PARTS = 8
#: A loan with more than this share of a bucket's rows is hot.
HOT_SHARE = 0.25
LAYOUT = "layout.json"


def bucket_count(df: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets of about ``bucket_bytes`` of ``df``'s input files."""
    return max(1, math.ceil(plan_size_bytes(df) / bucket_bytes))


def write_layout(df: DataFrame, path: str, key: str = "loan_id", order: tuple[str, ...] = ("published_at", "id"),
                 buckets: int | None = None, parts: Iterable[DataFrame] | None = None) -> int:
    """Write ``df`` under ``path``; returns the number of buckets.  ``path`` must be new.
    ``parts``: the rows of ``df`` split by key; files behind a part may go when the next is drawn."""
    spark = df.sparkSession
    n = buckets or bucket_count(df)
    versions = df.groupBy(key).agg(F.count("*").alias("n"))
    total = versions.agg(F.sum("n")).first()[0] or 0
    limit = max(1, int(HOT_SHARE * total / n))
    hot = [r[0] for r in versions.where((F.col("n") > limit) & F.col(key).isNotNull()).select(key).collect()]  # under n / HOT_SHARE keys
    is_hot = F.col(key).isin(hot) if hot else F.lit(False)
    if hot:  # first, while all of ``df`` can be read
        (df.where(is_hot).repartitionByRange(key, *order).sortWithinPartitions(key, *order)
         .write.parquet(f"{path}/hot"))
    name = _table(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    if parts is None:
        n_parts = min(MOST_PARTS, bucket_count(df, PART_BYTES))
        parts = [df.where(F.pmod(F.xxhash64(key), F.lit(n_parts)) == i) for i in range(n_parts)] if n_parts > 1 else [df]
    for part in parts:
        (part.where(~F.coalesce(is_hot, F.lit(False))).repartition(n, key)
         .write.mode("append").option("path", f"{path}/calm").option("compression", "zstd")
         .bucketBy(n, key).sortBy(key, *order).format("parquet").saveAsTable(name))
    files.write_new(spark, f"{path}/{LAYOUT}", json.dumps(
        {"key": key, "order": list(order), "buckets": n, "hot": bool(hot), "schema": json.loads(df.schema.json())}))
    return n


def _table(path: str) -> str:
    return "layout_" + hashlib.sha256(path.encode()).hexdigest()[:24]


def read_layout(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame | None]:
    """(bucketed part, hot part or None).  The bucketing stands in the session's
    catalog; a session that did not write the layout enters it there from ``path``."""
    text = "".join(r[0] for r in spark.read.text(f"{path}/{LAYOUT}", wholetext=True).collect())
    layout = json.loads(text)
    schema = T.StructType.fromJson(layout["schema"])
    name = _table(path)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        by = ", ".join(f"`{c}`" for c in [layout["key"], *layout["order"]])
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{layout['key']}`) SORTED BY ({by}) "
                  f"INTO {layout['buckets']} BUCKETS LOCATION '{path}/calm'")
    hot = spark.read.schema(schema).parquet(f"{path}/hot") if layout["hot"] else None
    return spark.table(name).select(*schema.fieldNames()), hot


def layout_ready(spark: SparkSession, path: str) -> bool:
    return files.exists(spark, f"{path}/{LAYOUT}")


def latest_of_layout(spark: SparkSession, path: str, key: str = "loan_id", order: tuple[str, ...] = ("published_at", "id")) -> DataFrame:
    """Latest visible version of every loan of a layout: no shuffle for the bucketed
    part, per-task reduction and a small one for hot loans."""
    calm, hot = read_layout(spark, path)
    out = latest_per_key(visible(calm), key, order)
    return out if hot is None else out.unionByName(latest_per_key(visible(hot), key, order))
