"""Derive a portfolio snapshot from the driver's TPC-H-style tables.

One snapshot row per ``orders`` row; the orders of one customer are the
published versions of one loan.  Payload arrays are built from the order's
``lineitem`` rows, the bankruptcy payloads from the customer's ``events``.

In two steps: :func:`build_versions` gathers what a version is made of, each
line and event once (``collect_list``, partial aggregation before the
shuffle), and :func:`render` writes the payload texts from that, row by row.
The texts repeat every line in ten payloads, so rows are moved and stored
before, and only the payloads that are read are written.  A payload array
belongs to one snapshot row by the data model, so its size is that of one
order's lines (or one user's events); nothing is gathered beyond one row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanweave.session import prepare_session
from loanweave.sources import contract

# Fixed values of the fixture.
DRIFT_SPLIT = "1998-01-01"
PLAN_TYPES = ["standard", "loan_mod_trial", "term_extension_trial", "deferment", "long_term"]
# Total order of an order's lines inside every payload array.
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity",
              "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare_session(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ts(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def _day(c: Column, plus: int = 0) -> Column:
    """Date text, ``plus`` days on: a cast and a sum of days, no formatter and no calendar interval."""
    day = c.cast("date")
    return (F.date_add(day, plus) if plus else day).cast("string")


def _plus_days(c: Column, n: int) -> Column:
    return c + F.expr(f"INTERVAL {n} DAYS")


def _when(cond: Column, value: Column) -> Column:
    return F.when(cond, value)


def _plain(c: Column) -> Column:
    """JSON text of a string that holds nothing to escape (made of digits, dates and signs)."""
    return F.concat(F.lit('"'), c, F.lit('"'))


def _text(c: Column) -> Column:
    """JSON text of any string."""
    one = F.to_json(F.array(c))
    return F.when(c.isNotNull(), F.substr(one, F.lit(2), F.length(one) - 2))


def _number(c: Column) -> Column:
    """JSON text of a double; those that are not finite are strings, as ``to_json`` writes them."""
    return F.when(F.abs(c) < F.lit(float("inf")), c.cast("string")).otherwise(_plain(c.cast("string")))


def _object(*fields: tuple[str, Column]) -> Column:
    """JSON object text of (name, JSON text); NULL fields are left out.  For payloads whose texts
    are parsed in the same plan, which then names the fields that are parsed only."""
    return F.concat(F.lit("{"), F.concat_ws(",", *[F.concat(F.lit(f'"{n}":'), c) for n, c in fields]), F.lit("}"))


def _array(objects: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(objects, ","), F.lit("]"))


def _line_payloads(c: Callable[[str], Column], drift_keys: bool
                   ) -> dict[str, tuple[Callable[[], Column] | None, Callable[[], Column]]]:
    """Payload element of one line: name -> (line filter, element struct or
    text), built on call.
    ``c(name)`` returns a line field (a column, or a field of a lambda variable)."""
    ship = c("l_shipdate")
    lid = F.concat_ws("-", c("l_orderkey"), c("l_linenumber"), c("l_partkey"), c("l_suppkey"),
                      F.date_format(ship, "yyyyMMdd"))
    supp = F.concat(F.lit("S"), c("l_suppkey").cast("string"))
    is_f = c("l_linestatus") == "F"
    dec = lambda n: c(n).cast("decimal(12,2)")

    installment_fields = [
        ("id", _plain(lid)),
        ("interest_amount", _number(c("l_tax"))),
        ("principal_amount", _number(c("l_extendedprice"))),
        ("late_fees_amount", _number(c("l_discount"))),
        ("adjusted_effective_date", _plain(_ts(ship))),
        ("original_effective_date", _plain(_day(ship))),
    ]
    if drift_keys:
        installment_fields = [(n, c) for n, c in installment_fields if n != "late_fees_amount"]
        installment_fields.append(("currency", _plain(F.lit("USD"))))

    return {
        "sale_info": (lambda: c("l_returnflag") == "R", lambda: F.struct(
            lid.alias("uuid"),
            _ts(ship).alias("sale_date"),
            supp.alias("debt_buyer"),
            c("l_partkey").alias("loan_task_id"),
            c("l_discount").alias("percentage_sold"),
            c("l_extendedprice").alias("sale_amount"),
            c("l_tax").alias("sale_fees_amount"),
            c("l_quantity").alias("sale_interest_amount"),
            c("l_extendedprice").alias("sale_principal_amount"),
            c("l_linenumber").alias("debt_sale_file_id"),
            _day(ship).alias("debt_sale_file_date"),
            lid.alias("debt_sale_file_uuid"),
            _when(is_f, _day(ship, 30)).alias("rebuy_date"),
            _when(is_f, c("l_quantity")).alias("rebuy_amount"),
            _when(is_f, F.lit("reversal")).alias("rebuy_reason"),
            _when(is_f, lid).alias("rebuy_file_uuid"),
            _when(is_f, _ts(_plus_days(ship, 30))).alias("rebuy_transaction_timestamp"),
            F.date_format(ship, "yyyy-MM-dd'T'HH:mm:ss").alias("sale_transaction_timestamp"),
        )),
        "settlements": (lambda: c("l_returnflag") == "A", lambda: F.struct(
            c("l_extendedprice").alias("amount"),
            c("l_linestatus").alias("status"),
            _ts(_plus_days(ship, 30)).alias("end_date"),
            _ts(ship).alias("start_date"),
            F.lit("ach").alias("payment_method"),
            supp.alias("settlement_type"),
            c("l_quantity").alias("number_of_payments"),
            _ts(ship).alias("transaction_timestamp"),
        )),
        "installments": (None, lambda: _object(*installment_fields)),
        "original_installments": (None, lambda: F.struct(
            lid.alias("id"),
            _ts(ship).alias("installment_date"),
            dec("l_tax").alias("original_interest"),
            dec("l_extendedprice").alias("original_principal"),
            c("l_partkey").alias("installment_schedule_id"),
        )),
        "financial_owners": (None, lambda: F.struct(
            supp.alias("legal_entity"),
            supp.alias("financial_owner"),
            c("l_returnflag").alias("financial_owner_type"),
            lid.alias("uuid"),
            _ts(ship).alias("financial_owner_eff_date"),
            _when(is_f, _ts(_plus_days(ship, 30))).alias("financial_owner_termination_date"),
            _when(is_f, F.lit("sold")).alias("financial_owner_termination_reason"),
            c("l_linestatus").alias("marketplace_status"),
            (c("l_discount") * 100).cast("decimal(12,2)").alias("marketplace_premium"),
            dec("l_extendedprice").alias("marketplace_final_principal_ar"),
            dec("l_quantity").alias("marketplace_final_interest_ar"),
        )),
        "collection_cases": (lambda: (c("l_returnflag") == "N") & (c("l_linestatus") == "O"), lambda: F.struct(
            lid.alias("case_type"),
            _ts(ship).alias("start_date"),
            _ts(_plus_days(ship, 90)).alias("end_date"),
            F.concat(F.lit("Agency "), c("l_suppkey").cast("string")).alias("agency_name"),
            F.concat(F.lit("agency"), c("l_suppkey").cast("string"),
                     F.lit("@example.com")).alias("agency_email"),
            F.concat(F.lit("555-"), c("l_suppkey").cast("string")).alias("agency_phone"),
            _day(ship).alias("poa_effective_date"),
        )),
        "operational_charge_offs": (lambda: is_f, lambda: F.struct(
            lid.alias("uuid"),
            _ts(ship).alias("charge_off_date"),
            c("l_returnflag").alias("charge_off_reason"),
            _when(c("l_returnflag") == "R", _ts(_plus_days(ship, 60))).alias("forgiveness_date"),
            c("l_quantity").alias("write_off_amount"),
            F.struct(c("l_tax").alias("fees"), c("l_discount").alias("interest"),
                     c("l_extendedprice").alias("principal")).alias("charge_off_amount"),
        )),
        "treasury_charge_offs": (lambda: c("l_returnflag") == "R", lambda: F.struct(
            lid.alias("uuid"),
            _ts(ship).alias("effective_date"),
            c("l_returnflag").alias("charge_off_reason"),
            _ts(ship).alias("transaction_timestamp"),
            lid.alias("id"),
            _when(c("l_linestatus") == "O", _ts(_plus_days(ship, 5))).alias("reverted_at"),
            _ts(ship).alias("updated_at"),
            lid.alias("source_uuid"),
            F.lit("order").alias("source_type"),
            is_f.alias("revertible"),
        )),
        "payment_plans": (None, lambda: F.struct(
            F.when(c("l_returnflag") == "A", "completed")
             .when(c("l_returnflag") == "R", "terminated")
             .otherwise("active").alias("status"),
            _day(ship, 7).alias("lock_in_date"),
            dec("l_extendedprice").cast("string").alias("total_amount"),
            dec("l_quantity").alias("payment_amount"),
            _when(is_f, _day(ship, 60)).alias("adjusted_end_date"),
            _day(ship, 30).alias("first_payment_date"),
            _when(c("l_returnflag") == "R", _day(ship, 45)).alias("early_terminate_date"),
            _when(c("l_linestatus") == "O", _day(ship, 10)).alias("adjusted_lock_in_date"),
            is_f.alias("tdr"),
            c("l_partkey").alias("id"),
            _day(ship).alias("start_date"),
            _day(ship, 90).alias("end_date"),
            F.concat(_day(ship), F.lit(" 03:04:05")).alias("created_timestamp"),
            # NULL line number -> no plan type (guarded: a NULL index into a
            # literal array is otherwise mis-typed as non-nullable in codegen)
            F.when(c("l_linenumber").isNotNull(),
                   F.get(F.array(*[F.lit(p) for p in PLAN_TYPES]),
                         (c("l_linenumber") % 5).cast("int"))).alias("plan_type"),
            lid.alias("uuid"),
            F.when(c("l_suppkey") % 2 == 0, "monthly").otherwise("biweekly").alias("frequency"),
            c("l_orderkey").alias("contract_id"),
            F.concat(_day(ship), F.lit(" 12:00:00")).alias("contract_signed_datetime"),
            c("l_suppkey").alias("created_by_id"),
            F.concat(_day(ship, 30), F.lit("|"), _day(ship, 60)).alias("payment_dates"),
            F.concat(F.lit("v"), (c("l_linenumber") % 3).cast("string")).alias("rule_version"),
            (c("l_returnflag") == "N").cast("string").alias("freezes_lateness"),
            _when(is_f, _day(ship, 120)).alias("lateness_reset_date"),
            F.concat(_day(ship, 1), F.lit(" 23:30:00")).alias("updated_at"),
        )),
        # Rate schedule lives inside the loan_data object.
        "_rate_schedule": (None, lambda: F.struct(
            c("l_tax").cast("decimal(4,2)").cast("string").alias("interest_rate"),
            _day(ship).alias("effective_date"),
        )),
    }


def order_lines(lineitem: DataFrame) -> DataFrame:
    """One row per order key with its lines (``_lines``), each line once, in LINE_ORDER.
    Structs, so that files of them hold each field by itself."""
    return lineitem.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct(*LINE_ORDER))).alias("_lines"))


def user_days(events: DataFrame) -> DataFrame:
    """Per user their events by day (``_days``), in time order, each event once."""
    status = (F.when(F.col("event_type") == "error", "petitioned")
              .when(F.col("event_type") == "purchase", "discharged")
              .otherwise(F.col("event_type")).alias("status"))
    # By (user, day) first: a user with very many events is spread over days
    # before one row per day of theirs meets.
    per_day = events.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.sort_array(F.collect_list(F.struct("ts", "event_id", status))).alias("events"))
    return per_day.groupBy("user_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("day", "events"))), lambda x: x["events"]).alias("_days"))


def _chapter(e: Column) -> Column:
    return F.when(e["event_id"] % 2 == 0, "7").otherwise("13")


def _timeline(days: Column) -> Column:
    """Text of the bankruptcy timeline, one entry per day."""
    def event(e: Column) -> Column:
        return _object(("date", _plain(F.date_format(e["ts"], "yyyy-MM-dd HH:mm:ss.SSSSSS"))), ("status", _text(e["status"])),
                       ("chapter", _plain(_chapter(e))), ("event_id", _plain(e["event_id"].cast("string"))))
    return _array(F.transform(days, lambda d: _object(("event_history", _array(F.transform(d, event))))))


def _claims(days: Column) -> Column:
    """Bankruptcy claims: the sign-ups in time order."""
    return F.transform(F.filter(F.flatten(days), lambda e: e["status"] == "signup"), lambda e: F.struct(
        F.lit("filed").alias("status"), _chapter(e).alias("chapter"), _day(e["ts"]).alias("effective_date")))


def read_orders(spark: SparkSession, sf_dir: str, half: str | None = None) -> DataFrame:
    """The orders of a half (all of them without one)."""
    orders = read_table(spark, sf_dir, "orders")
    if half == "before":
        return orders.filter(F.col("o_orderdate") < F.lit(DRIFT_SPLIT).cast("timestamp_ntz"))
    if half == "after":
        return orders.filter(F.col("o_orderdate") >= F.lit(DRIFT_SPLIT).cast("timestamp_ntz"))
    return orders


def newest_days(spark: SparkSession, sf_dir: str, half: str | None = None) -> DataFrame:
    """(n_custkey, n_orderkey, user_id, _days): the version that holds a user's events."""
    # The newest visible version of each loan: one partial maximum per customer.
    newest = read_orders(spark, sf_dir, half).groupBy(F.col("o_custkey").alias("n_custkey")).agg(
        F.max(F.struct(F.coalesce(F.col("o_orderstatus") != "P", F.lit(False)).alias("shown"), F.col("o_orderdate").alias("day"),
                       F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderkey").alias("key")))["key"].alias("n_orderkey"))
    return newest.join(user_days(read_table(spark, sf_dir, "events")), F.col("n_custkey") == F.col("user_id"))


def part_of(key: Column, n: int) -> Column:
    """Which of ``n`` parts a key is in."""
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(n)).cast("int")


def build_versions(spark: SparkSession, sf_dir: str, half: str | None = None, days: DataFrame | None = None,
                   part: tuple[int, int] = (0, 1)) -> DataFrame:
    """What the versions of ``orders`` ⋈ ``lineitem`` ⋈ ``customer`` ⋈ ``events`` are made of.

    ``part`` = (i, n): the orders of one of n parts.  ``days``: :func:`newest_days`, if staged.

    A user's bankruptcy events stand on the newest visible version of their
    loan only (the newest of all if none is visible), as a source that
    publishes the current state would hold them; copying them onto every
    version would make orders x events of them.
    """
    i, n = part
    orders, lineitem = read_orders(spark, sf_dir, half), read_table(spark, sf_dir, "lineitem")
    if n > 1:
        orders, lineitem = orders.where(part_of(F.col("o_orderkey"), n) == i), lineitem.where(part_of(F.col("l_orderkey"), n) == i)
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    if days is None:
        days = newest_days(spark, sf_dir, half)
    if n > 1:
        days = days.where(part_of(F.col("n_orderkey"), n) == i)
    lines = order_lines(lineitem)
    # The per-customer data joins the narrow orders first, the lines come last.
    j = (orders.join(customer, F.col("o_custkey") == customer.c_custkey, "left")
         .join(days, (F.col("o_custkey") == F.col("n_custkey")) & (F.col("o_orderkey") == F.col("n_orderkey")), "left")
         .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left"))
    return j.select(
        F.col("o_custkey").cast("string").alias("loan_id"),
        F.col("o_orderkey").cast("string").alias("id"),
        (F.col("o_orderstatus") == "P").alias("dark"),
        F.col("o_orderdate").alias("published_at"),
        F.col("o_orderpriority").alias("_priority"), F.col("c_mktsegment").alias("_segment"), "_lines", "_days")


def outer_columns(versions: DataFrame) -> DataFrame:
    """Versions with every outer column of the contract."""
    day = F.col("published_at")
    more = {"portfolios_created_at": day, "accounts_created_at": day, "accounts_updated_at": _plus_days(day, 1),
            "accounts_build_end_time": _plus_days(day, 30), "servicing_account_id": F.concat(F.lit("A"), F.col("loan_id")),
            "etl_ingestion_time": day, "source_file_creation_time": day}
    own = [c for c in versions.columns if c not in VERSION_COLUMNS]
    return versions.select(*own, *[c.alias(n) for n, c in more.items()], *VERSION_COLUMNS)


#: Columns of a version that its payload texts are written from.
VERSION_COLUMNS = ("_priority", "_segment", "_lines", "_days")


def render(versions: DataFrame, drift_keys: bool = False, keep: bool = False) -> DataFrame:
    """Snapshot rows of versions under their outer columns: the payload texts are written.
    ``keep``: the columns that they are written from stay, to write texts again later."""
    empty = F.array().cast("array<string>")
    def js(c: Column) -> Column:
        return F.coalesce(F.to_json(c), F.to_json(empty))

    key = F.col("id").cast("bigint")

    def part(name: str, i: int) -> Callable[[Column], Column]:
        return lambda x: _line_payloads(lambda n: key if n == "l_orderkey" else x[n], drift_keys)[name][i]()

    arrays = {}
    for name, (cond, _) in _line_payloads(F.col, drift_keys).items():
        arr = F.col("_lines") if cond is None else F.filter("_lines", part(name, 0))
        arrays[name] = F.transform(arr, part(name, 1))
    schedule = versions.select(arrays["_rate_schedule"].alias("s")).schema["s"].dataType
    installments = _array(arrays.pop("installments"))
    texts = {
        "loan_data": F.to_json(F.struct(
            (key % 60).alias("term"),
            F.col("loan_id").alias("loan_id"),
            F.sha2("loan_id", 256).alias("loan_uuid"),
            F.col("_priority").alias("payment_method"),
            F.when(F.col("_segment") == "FURNITURE", "CA")
             .when(F.col("_segment") == "MACHINERY", "MO")
             .otherwise("TX").alias("origination_state"),
            F.coalesce(arrays.pop("_rate_schedule"), F.array().cast(schedule)).alias("interest_rate_schedule"),
        )),
        "customer_information": F.to_json(F.struct(F.col("loan_id").cast("bigint").alias("customer_id"))),
        **{name: js(arr) for name, arr in arrays.items()},
        "installments": F.coalesce(installments, F.lit("[]")),
        "bankruptcy_timeline": F.coalesce(_timeline(F.col("_days")), F.lit("[]")),
        "bankruptcy_claims": js(_claims(F.col("_days"))),
    }
    names = contract.SNAPSHOT_SCHEMA.fieldNames()
    outer = [c for c in versions.columns if c not in VERSION_COLUMNS]
    return versions.select(*[c for c in names if c in outer and c not in texts],
                        *[texts[c].alias(c) for c in names if c in texts], *[c for c in outer if c not in names],
                           *(VERSION_COLUMNS if keep else ()))


def build_snapshot(spark: SparkSession, sf_dir: str, half: str | None = None) -> DataFrame:
    """Portfolio snapshot derived from ``orders`` ⋈ ``lineitem`` ⋈ ``customer`` ⋈ ``events``.

    ``half`` = ``"before"`` / ``"after"`` keeps orders dated before / from
    DRIFT_SPLIT; the ``"after"`` half's installments gain ``currency`` and
    lose ``late_fees_amount`` (input of the drift reports)."""
    versions = outer_columns(build_versions(spark, sf_dir, half))
    return render(versions, half == "after")


def redefine_outer(snapshot: DataFrame) -> DataFrame:
    """The same versions under changed outer columns: ``accounts_build_end_time`` is
    gone, ``etl_ingestion_time`` is a date, ``servicing_region`` is new."""
    return (snapshot.drop("accounts_build_end_time")
            .withColumn("etl_ingestion_time", F.col("etl_ingestion_time").cast("date"))
            .withColumn("servicing_region", F.substring("servicing_account_id", 1, 1)))
