"""Registered queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Table queries run the mart builds over the snapshot derived from the
driver's tables; operator queries exercise one operator each, over the
snapshot or directly over a driver table.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loanweave.functions import casts
from loanweave.functions.json import (
    array_elements, array_or_object, first_event_date, parse_array, parse_object, path_text,
)
from loanweave.functions.keys import hash_concat, surrogate_key
from loanweave.operators import drift, late, publish, sink
from loanweave.operators.snapshot import non_empty, rename_by_mapping, visible
from loanweave.plans import tables as TB
from loanweave.session import scratch_path, stage
from loanweave.sources import bucketed
from loanweave.sources import contract as C
from loanweave.sources.fixture import VERSION_COLUMNS, read_table
from loanweave.sources.snapshot import (
    portfolio_footer, portfolio_layout, portfolio_rows, portfolio_snapshot, portfolio_versions, render_versions,
)

Query = Callable[[SparkSession, str], DataFrame]


def _snap(spark: SparkSession, sf_dir: str) -> DataFrame:
    snap = portfolio_snapshot(spark, sf_dir)
    return snap


def _latest(spark: SparkSession, sf_dir: str, half: str | None = None) -> DataFrame:
    """Latest visible version of every loan.  Versions are ranked as they are staged and
    payload texts written for the winners, so no sort or shuffle carries the others' texts."""
    return portfolio_rows(TB.latest(portfolio_versions(spark, sf_dir, half)), sf_dir, half)


# --------------------------------------------------------------------------- tables

def _payload_query(name: str, observed: bool) -> Query:
    spec = TB.PAYLOAD_TABLES[name]

    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        if observed:
            return TB.payload_table_observed(visible(_snap(spark, sf_dir)), _latest(spark, sf_dir), spec)
        return TB.payload_table(_latest(spark, sf_dir), spec)
    q.__name__ = name + ("_observed" if observed else "")
    return q


def bankruptcy(spark, sf_dir):
    return TB.bankruptcy(_latest(spark, sf_dir))


def bankruptcy_observed(spark, sf_dir):
    return TB.bankruptcy_observed(_latest(spark, sf_dir))


def interest_rate(spark, sf_dir):
    return TB.interest_rate(_latest(spark, sf_dir))


def interest_rate_observed(spark, sf_dir):
    return TB.interest_rate_observed(visible(_snap(spark, sf_dir)))


def interest_rate_observed_versions(spark, sf_dir):
    return TB.interest_rate_observed_versions(visible(_snap(spark, sf_dir)))


def payment_plan(spark, sf_dir):
    """The plan texts of the winners are written after the ranking, as in :func:`_latest`."""
    versions = render_versions(portfolio_versions(spark, sf_dir), sf_dir, keep=True)
    top = TB.latest_with_plans(versions, "loan_id", *VERSION_COLUMNS)
    return TB.payment_plan_rows(render_versions(top, sf_dir))


# ------------------------------------------------------------------------ operators

def snapshot_scan(spark, sf_dir):
    return _snap(spark, sf_dir).select(*C.SCALAR_COLUMNS)


# A rename mapping in the source's CRLF-joined form, with one
# name that is not a column.
RENAME_OLD = "o_orderkey\r\no_custkey\r\no_clerk"
RENAME_NEW = "order_id\r\ncustomer_id\r\nclerk_name"


def rename_by_mapping_q(spark, sf_dir):
    return rename_by_mapping(read_table(spark, sf_dir, "orders"), RENAME_OLD, RENAME_NEW)


def visible_rows(spark, sf_dir):
    return visible(_snap(spark, sf_dir)).select("loan_id", "id")


def latest_per_key_q(spark, sf_dir):
    return _latest(spark, sf_dir).select("loan_id", "id", "published_at")


def latest_by_ids(spark, sf_dir):
    """Latest versions by a ranking of ids alone, a payload fetched for the winners."""
    vis = visible(portfolio_versions(spark, sf_dir))
    ids = late.latest_ids(vis)
    with late.bloom_filters(spark, ids.count()):
        won = stage(late.fetch_latest(vis, ids, ties=late.has_ties(ids)), "latest_rows")
    return portfolio_rows(won, sf_dir).select(
        "loan_id", "id", "published_at", F.coalesce(F.json_array_length("installments"), F.lit(0)).alias("n_installments"))


def latest_of_buckets(spark, sf_dir):
    """Latest versions of the bucketed layout, ranked without a shuffle."""
    latest = bucketed.latest_of_layout(spark, portfolio_layout(spark, sf_dir))
    return render_versions(latest, sf_dir).select(
        "loan_id", "id", "published_at", F.coalesce(F.json_array_length("installments"), F.lit(0)).alias("n_installments"))


def non_empty_payload(spark, sf_dir):
    return non_empty(_snap(spark, sf_dir), "installments").select("loan_id", "id")


def json_object_fields(spark, sf_dir):
    ld = parse_object("loan_data", C.LOAN_DATA)
    return _snap(spark, sf_dir).select(
        "id", ld["loan_id"].alias("loan_id"), ld["loan_uuid"].alias("loan_uuid"),
        ld["payment_method"].alias("payment_method"),
        ld["origination_state"].alias("origination_state"), ld["term"].alias("term"))


def json_array_elements(spark, sf_dir):
    arr = array_elements("installments")
    s = _snap(spark, sf_dir).select("id", arr.alias("arr"))
    return s.select("id", F.size("arr").alias("n_elements"),
                    F.posexplode("arr").alias("pos", "elem")).select(
        "id", "n_elements", "pos", path_text("elem", "id").alias("element_id"))


def json_array_rows(spark, sf_dir):
    rows = visible(_snap(spark, sf_dir)).select(
        "id", F.explode(parse_array("installments", C.pick(
            C.INSTALLMENTS, "id", "principal_amount", "adjusted_effective_date"))).alias("e"))
    return TB._ntz(rows.select(
        "id", F.col("e")["id"].alias("installment_id"),
        F.col("e")["principal_amount"].alias("principal_amount"),
        F.col("e")["adjusted_effective_date"].alias("adjusted_effective_date")))


def array_nth(spark, sf_dir):
    arr = parse_array("installments", C.pick(C.INSTALLMENTS, "id"))
    return _snap(spark, sf_dir).select("id", F.get(arr, 1)["id"].alias("second_id"))


def json_path(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    return ev.select("event_id", casts.to_int(path_text("props", "k")).alias("k"))


def json_array_or_object(spark, sf_dir):
    def n(c):
        arr = array_or_object(c)
        return F.when(arr.isNull(), F.lit(0)).otherwise(F.size(arr)).alias("n_elements")
    ev = read_table(spark, sf_dir, "events").select(
        F.lit("event").alias("source"), F.col("event_id").cast("string").alias("key"), n("props"))
    sn = _snap(spark, sf_dir).select(
        F.lit("snapshot").alias("source"), F.col("id").alias("key"), n("payment_plans"))
    return ev.unionByName(sn)


def surrogate_key_q(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     surrogate_key("l_orderkey", "l_linenumber", "l_shipdate").alias("row_key"))


def hash_concat_q(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    b = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    return o.select("o_orderkey", hash_concat(F.sha2(F.col("o_orderkey").cast("string"), 256),
                                              F.sha2(b, 256)).alias("pair_hash"))


def child_ordinal(spark, sf_dir):
    rows = _latest(spark, sf_dir).select(
        "loan_id", "id",
        F.posexplode(parse_array("installments", C.pick(C.INSTALLMENTS, "id", "adjusted_effective_date"))).alias("ordinal", "e"))
    # ``id`` is unique within a loan: partitioning by (loan_id, id) is the same
    # grouping and reuses the latest frame's partitioning (no second shuffle).
    w = Window.partitionBy("loan_id", "id").orderBy(F.col("e")["adjusted_effective_date"],
                                                    F.col("ordinal"))
    return rows.select("id", "ordinal", F.col("e")["id"].alias("installment_id"),
                       F.row_number().over(w).alias("date_rank"))


def typed_casts(spark, sf_dir):
    p = read_table(spark, sf_dir, "part")
    size_text = F.col("p_size").cast("string")
    return p.select(
        "p_partkey",
        casts.to_int(F.col("p_brand")).alias("brand_as_int"),
        casts.to_int(size_text).alias("size_as_int"),
        casts.to_int(F.concat(size_text, F.lit(".0"))).alias("size_fraction_as_int"),
        casts.to_decimal(F.col("p_retailprice").cast("string")).alias("price_as_decimal"),
        casts.to_date(F.concat(F.lit("1998-01-"), F.lpad(size_text, 2, "0"))).alias("day_as_date"),
        casts.to_bool(F.when(F.col("p_size") % 3 == 0, "true")
                      .when(F.col("p_size") % 3 == 1, "false")
                      .otherwise(F.col("p_type"))).alias("flag_as_bool"))


def utc_to_central(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    return ev.select("event_id", "ts", casts.utc_to_central(F.col("ts")).alias("central_ts"))


def distinct_rows(spark, sf_dir):
    return read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").distinct()


def left_join_children(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    first = (read_table(spark, sf_dir, "lineitem").groupBy("l_orderkey")
             .agg(F.min("l_shipdate").alias("first_ship_date")))
    return o.join(first, o.o_orderkey == first.l_orderkey, "left").select(
        "o_orderkey", "o_orderdate", "first_ship_date")


def first_event_dates(spark, sf_dir):
    lat = non_empty(_latest(spark, sf_dir), "bankruptcy_timeline")
    bound = TB.bind_timeline(lat, "_timeline", "bankruptcy_timeline", C.pick(C.BANKRUPTCY_EVENT, "date", "status"))
    events = bound.withColumn("_events", F.flatten(F.transform("_timeline", lambda e: e["event_history"])))
    return events.select("loan_id",
                         first_event_date(F.col("_events"), "petitioned").alias("first_petitioned"),
                         first_event_date(F.col("_events"), "discharged").alias("first_discharged"))


def table_row_counts(spark, sf_dir):
    """Row count of each of the eleven tables.  Nine are single generators
    over the latest frame and are counted from array sizes in one pass (one
    narrow ranking shuffle for all of them); the deduplicated table and the
    payment plans, which rank versions differently, are counted as built."""
    counted = TB.generated_row_counts(_snap(spark, sf_dir))
    parts = [counted] + [
        TABLE_QUERIES[name](spark, sf_dir).agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(name).alias("table_name"), "n_rows")
        for name in ("original_installment", "payment_plan")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


DRIFT_PAYLOADS = tuple(C.PAYLOAD_COLUMNS)


def payload_key_drift(spark, sf_dir):
    return drift.payload_key_drift(portfolio_snapshot(spark, sf_dir, "before"),
                                   portfolio_snapshot(spark, sf_dir, "after"), DRIFT_PAYLOADS)


def payload_path_drift(spark, sf_dir):
    """Occurrences of every nested path of every payload column in the two halves."""
    return drift.payload_path_drift(portfolio_snapshot(spark, sf_dir, "before"),
                                    portfolio_snapshot(spark, sf_dir, "after"), DRIFT_PAYLOADS)


def payload_schema(spark, sf_dir):
    """Schema of every payload column as rows (payload, path, type, nullable, n)."""
    return drift.payload_schema(_snap(spark, sf_dir), DRIFT_PAYLOADS)


def schema_drift(spark, sf_dir):
    """Outer columns and payload paths of the two halves side by side."""
    return drift.schema_drift(spark, portfolio_footer(spark, sf_dir, "before"),
                              portfolio_footer(spark, sf_dir, "drifted"), DRIFT_PAYLOADS)


def outer_schema_drift(spark, sf_dir):
    """Outer columns of the two halves, each under its own file footer, with the values they hold."""
    return drift.outer_schema_drift(spark, portfolio_footer(spark, sf_dir, "before"),
                                    portfolio_footer(spark, sf_dir, "drifted"))


# Fixed values of the round-trip check.
SINK_DATE = dt.date(2024, 1, 2)
SINK_AS_OF = dt.datetime(2024, 1, 2, 6, 0, 0)


def sink_roundtrip(spark, sf_dir):
    df = active_installment_q(spark, sf_dir)
    root = scratch_path(spark, "mart_roundtrip", uuid.uuid4().hex)  # calls never share a folder
    out = sink.write_table(df, root, "active_installment", SINK_DATE, SINK_AS_OF)
    return spark.read.parquet(out).filter(F.col("extract_date") == F.lit(SINK_DATE))


# The tables and date of the publication check.
PUBLISHED_TABLES = ("active_installment", "treasury_charge_off")


def published_date(spark, sf_dir):
    """Rows that readers see of a date: a first run, a second one that replaces it, and a third
    that dies before its commit, after it has written a table."""
    root = scratch_path(spark, "published", uuid.uuid4().hex)

    def tables(half):
        latest = _latest(spark, sf_dir, half)
        return {n: TB.payload_table(latest, TB.PAYLOAD_TABLES[n]) for n in PUBLISHED_TABLES}

    for half in ("before", None):
        with publish.Publication(spark, root, SINK_DATE, SINK_AS_OF) as run:
            for name, df in tables(half).items():
                run.write(df, name)
    dead = publish.Publication(spark, root, SINK_DATE, SINK_AS_OF)
    dead.write(tables("after")[PUBLISHED_TABLES[0]], PUBLISHED_TABLES[0])
    seen = [publish.read_published(spark, root, n).select(F.lit(n).alias("table_name"), "extract_date", "loan_id")
            for n in PUBLISHED_TABLES]
    return seen[0].unionByName(seen[1]).groupBy("table_name", "extract_date", "loan_id").agg(F.count("*").alias("n_rows"))


active_installment_q = _payload_query("active_installment", False)

TABLE_QUERIES: dict[str, Query] = {
    "loan_debt_sale": _payload_query("loan_debt_sale", False),
    "loan_servicing_settlement": _payload_query("loan_servicing_settlement", False),
    "active_installment": active_installment_q,
    "bankruptcy": bankruptcy,
    "interest_rate": interest_rate,
    "loan_collection_case": _payload_query("loan_collection_case", False),
    "loan_financial_owner": _payload_query("loan_financial_owner", False),
    "operational_charge_off": _payload_query("operational_charge_off", False),
    "original_installment": _payload_query("original_installment", False),
    "treasury_charge_off": _payload_query("treasury_charge_off", False),
    "payment_plan": payment_plan,
}

OBSERVED_QUERIES: dict[str, Query] = {
    **{f"{n}_observed": _payload_query(n, True) for n in TB.PAYLOAD_TABLES},
    "bankruptcy_observed": bankruptcy_observed,
    "interest_rate_observed": interest_rate_observed,
    "interest_rate_observed_versions": interest_rate_observed_versions,
}

OPERATOR_QUERIES: dict[str, Query] = {
    "snapshot_scan": snapshot_scan,
    "rename_by_mapping": rename_by_mapping_q,
    "visible_rows": visible_rows,
    "latest_per_key": latest_per_key_q,
    "latest_by_ids": latest_by_ids,
    "latest_of_buckets": latest_of_buckets,
    "non_empty_payload": non_empty_payload,
    "json_object_fields": json_object_fields,
    "json_array_elements": json_array_elements,
    "json_array_rows": json_array_rows,
    "array_nth": array_nth,
    "json_path": json_path,
    "json_array_or_object": json_array_or_object,
    "surrogate_key": surrogate_key_q,
    "hash_concat": hash_concat_q,
    "child_ordinal": child_ordinal,
    "typed_casts": typed_casts,
    "utc_to_central": utc_to_central,
    "distinct_rows": distinct_rows,
    "left_join_children": left_join_children,
    "first_event_dates": first_event_dates,
    "table_row_counts": table_row_counts,
    "payload_key_drift": payload_key_drift,
    "payload_path_drift": payload_path_drift,
    "payload_schema": payload_schema,
    "schema_drift": schema_drift,
    "outer_schema_drift": outer_schema_drift,
    "sink_roundtrip": sink_roundtrip,
    "published_date": published_date,
}

QUERIES: dict[str, Query] = {**TABLE_QUERIES, **OBSERVED_QUERIES, **OPERATOR_QUERIES}
