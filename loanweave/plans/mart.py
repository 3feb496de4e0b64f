"""The whole mart as one Spark application.

Three ways to the latest version of a loan.  By default (``table``) every table
ranks the versions itself: its shuffle carries the ids, ``loan_data`` and the one or
two payloads it unpacks, never the other columns, and partial top-1 drops most
older versions before it.  ``late`` ranks ids once for all tables and lets each
fetch its columns of the winners (:mod:`loanweave.operators.late`).  ``shared``
ranks once, stages the whole latest frame in the shared folder and lets the
tables read that; it moves all columns once.  Table writes are submitted
concurrently so small tables overlap with large ones, and published together.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from loanweave.operators import late
from loanweave.operators.publish import Publication
from loanweave.operators.snapshot import visible
from loanweave.plans import tables as TB
from loanweave.session import drop_staged, plan_size_bytes, scratch_path, sized_shuffles
from loanweave.sources import contract

Build = Callable[[DataFrame, DataFrame, DataFrame], DataFrame]  # (snapshot, visible, latest)


def _payload(name: str, observed: bool) -> Build:
    spec = TB.PAYLOAD_TABLES[name]
    if observed:
        return lambda s, v, l: TB.payload_table_observed(v, l, spec)  # noqa: E741
    return lambda s, v, l: TB.payload_table(l, spec)  # noqa: E741


MART_TABLES: dict[str, Build] = {
    "loan_debt_sale": _payload("loan_debt_sale", False),
    "loan_servicing_settlement": _payload("loan_servicing_settlement", False),
    "active_installment": _payload("active_installment", False),
    "bankruptcy": lambda s, v, l: TB.bankruptcy(l),  # noqa: E741
    "interest_rate": lambda s, v, l: TB.interest_rate(l),  # noqa: E741
    "loan_collection_case": _payload("loan_collection_case", False),
    "loan_financial_owner": _payload("loan_financial_owner", False),
    "operational_charge_off": _payload("operational_charge_off", False),
    "original_installment": _payload("original_installment", False),
    "treasury_charge_off": _payload("treasury_charge_off", False),
    "loan_payment_plan": lambda s, v, l: TB.payment_plan(s),  # noqa: E741
}

OBSERVED_TABLES: dict[str, Build] = {
    **{f"{n}_observed": _payload(n, True) for n in TB.PAYLOAD_TABLES},
    "bankruptcy_observed": lambda s, v, l: TB.bankruptcy_observed(l),  # noqa: E741
    "interest_rate_observed": lambda s, v, l: TB.interest_rate_observed(v),  # noqa: E741
    "interest_rate_observed_versions":
        lambda s, v, l: TB.interest_rate_observed_versions(v),  # noqa: E741
}


def stage_latest(spark: SparkSession, snapshot: DataFrame) -> tuple[DataFrame, str]:
    """Compute the latest visible version per loan once and read it back
    from a staged parquet table in the shared checkpoint folder."""
    path = scratch_path(spark, "staging", f"latest_{uuid.uuid4().hex}")
    TB.latest(snapshot).write.mode("overwrite").parquet(path)
    return spark.read.schema(snapshot.schema).parquet(path), path


def _drop_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def build_mart(spark: SparkSession, snapshot: DataFrame, observed: bool = False,
               latest_frame: DataFrame | None = None) -> dict[str, DataFrame]:
    """All table frames over one snapshot.  Without ``latest_frame`` every
    table recomputes the latest versions itself (the source system's shape)."""
    vis = visible(snapshot)
    lat = latest_frame if latest_frame is not None else TB.latest(snapshot)
    builds = {**MART_TABLES, **(OBSERVED_TABLES if observed else {})}
    return {name: b(snapshot, vis, lat) for name, b in builds.items()}


def widest_table_bytes(snapshot: DataFrame, shared: bool) -> int:
    """Catalyst's size of what the widest ranking shuffle carries."""
    if shared:
        return plan_size_bytes(snapshot)
    ids = ["loan_id", "id", "published_at", "loan_data"]
    carried = [[p] for p in contract.PAYLOAD_ARRAY_COLUMNS if not p.startswith("bankruptcy")]
    carried.append(["bankruptcy_timeline", "bankruptcy_claims"])
    return max(plan_size_bytes(snapshot.select(*ids, *c)) for c in carried)


def run_mart(spark: SparkSession, snapshot: DataFrame, out_root: str,
             extract_date: dt.date, as_of: dt.datetime | None = None, observed: bool = False,
             ranking: str = "table", parallelism: int = 4) -> dict[str, str]:
    """Build and write every table, then publish them together as the tables of
    ``extract_date`` (:mod:`loanweave.operators.publish`); returns their folders.
    ``ranking``: ``table``, ``late`` or ``shared``, see above."""
    if ranking not in ("table", "late", "shared"):
        raise ValueError(f"unknown ranking {ranking}")
    with contextlib.ExitStack() as held:
        held.enter_context(sized_shuffles(spark, widest_table_bytes(snapshot, ranking == "shared")))
        lat = None
        if ranking == "shared":
            lat, staged = stage_latest(spark, snapshot)
            held.callback(_drop_path, spark, staged)
        elif ranking == "late":
            ids = late.latest_ids(visible(snapshot))
            held.callback(drop_staged, ids)
            held.enter_context(late.bloom_filters(spark, ids.count()))
            lat = late.fetch_latest(visible(snapshot), ids, ties=late.has_ties(ids))
        frames = build_mart(spark, snapshot, observed=observed, latest_frame=lat)
        with Publication(spark, out_root, extract_date, as_of) as run, \
                ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            futures = {name: pool.submit(run.write, df, name) for name, df in frames.items()}
            return {name: f.result() for name, f in futures.items()}
