"""Latest versions by ranking ids only, payloads fetched afterwards.

The ranking reads and shuffles (key, order columns) alone, once for all tables.
Its winners, one row per key, are staged; a table then joins its few columns
with them.  If the winners are small, Spark broadcasts them and no payload is
shuffled at all.  If not, a Bloom filter of the winners drops the older
versions in the scan, so the join shuffles about one version per key, whatever
order the snapshot is in.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanweave.operators.snapshot import latest_per_key
from loanweave.session import stage

#: Most winners for which a Bloom filter is built, at ten bits each (64 MB in every task).
BLOOM_MOST_ROWS = 50_000_000
BLOOM_BITS_A_ROW = 10


def latest_ids(versions: DataFrame, key: str = "loan_id", order: Sequence[str] = ("published_at", "id")) -> DataFrame:
    """(key, order columns, copies): the winning version of each key, staged.
    ``copies`` counts rows that share all of these; a partial count runs before the shuffle."""
    distinct = versions.groupBy(key, *order).agg(F.count("*").alias("copies"))
    return stage(latest_per_key(distinct, key, order), "latest_ids")


def fetch_latest(versions: DataFrame, ids: DataFrame, key: str = "loan_id",
                 order: Sequence[str] = ("published_at", "id"), ties: bool = True) -> DataFrame:
    """The rows of ``versions`` that won, one per key.

    ``ties``: some winner is several rows with equal key and order (see
    :func:`has_ties`); those few are then ranked as rows."""
    columns = [key, *order]
    wanted = ids.select(*[F.col(c).alias(f"_won_{c}") for c in columns], "copies")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_won_{c}")) for c in columns])
    single = versions.join(wanted.where("copies = 1"), same, "left_semi")
    if not ties:
        return single
    several = versions.join(wanted.where("copies > 1"), same, "left_semi")
    return single.unionByName(latest_per_key(several, key, order))


def has_ties(ids: DataFrame) -> bool:
    return ids.where("copies > 1").limit(1).count() > 0


@contextlib.contextmanager
def bloom_filters(spark: SparkSession, n_rows: int) -> Iterator[None]:
    """Let joins with ``n_rows`` winners that are not broadcast filter the other
    side's scan by a Bloom filter; settings are put back afterwards."""
    prefix = "spark.sql.optimizer.runtime.bloomFilter."
    conf = {f"{prefix}enabled": "true", f"{prefix}applicationSideScanSizeThreshold": "0",
            f"{prefix}creationSideThreshold": str(1 << 40), f"{prefix}maxNumItems": str(max(n_rows, 1)),
            f"{prefix}expectedNumItems": str(max(n_rows, 1)), f"{prefix}maxNumBits": str(BLOOM_BITS_A_ROW * max(n_rows, 100))}
    if n_rows > BLOOM_MOST_ROWS:
        conf = {f"{prefix}enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
