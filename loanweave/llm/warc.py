"""Content-addressed web archive.

Every page becomes one WARC record.  A payload's bytes are stored once, in
the ``payloads`` table under their SHA-256; the exact record headers (WARC and
HTTP part) stand in the ``headers`` table and name the digest.  Records come
back by joining the two, and every joined payload is checked against both its
digests and the length its header states.

Scale: payloads are hashed in the scan, so copies are found by shuffling ids
and digests only (partial maximum per digest; a payload that a third of all
pages share sends one row per task).  Payload bytes move once to be stored and
once to be read back; the largest ids per digest are staged before they are
joined, so AQE splits a hot digest.  Both tables are plain Parquet in the shared folder.

Defined results: a null page is an empty payload; a null URL is recorded as
``urn:page:<id>``, line breaks in URLs are percent-encoded; copies with the
largest page_id that are repeated rows are all responses, their bytes are
stored once; a null page_id ranks below all others; an empty table gives two
empty tables; other columns of the input are not read.
"""

from __future__ import annotations

import gzip
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanweave.operators.joins import join_aggregate
from loanweave.session import app_scratch, drop_staged, shuffles_dropped, stage

CRLF = "\r\n"
#: RFC 4648 digits.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DEFAULT_DATE = "2024-01-01T00:00:00Z"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 of ``payload`` in upper-case base32: 20 bits (5 hex digits) give 4 digits."""
    hexed = F.sha1(payload)
    groups = [F.conv(F.substring(hexed, 1 + 5 * g, 5), 16, 10).cast("int") for g in range(8)]
    return F.concat(*[F.substr(F.lit(BASE32), F.shiftright(v, 15 - 5 * k).bitwiseAND(31) + 1, F.lit(1))
                      for v in groups for k in range(4)])


def _urn(page_id: Column) -> Column:
    return F.concat(F.lit("urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")))


def _with_payload(pages: DataFrame) -> DataFrame:
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    return pages.select("page_id", F.col("url").cast("string").alias("url"), payload.alias("payload"))


def record_header(page_id: Column, url: Column, n_bytes: Column, sha1: Column,
                  is_revisit: Column, refers_to: Column, date: str) -> Column:
    """The bytes before the payload: WARC header, blank line, HTTP header, blank line."""
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    n_bytes.cast("string"), F.lit(CRLF * 2))
    block = F.octet_length(http) + F.when(is_revisit, F.lit(0)).otherwise(n_bytes)
    target = F.coalesce(F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")),
                        _urn(page_id))
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: "), F.when(is_revisit, "revisit").otherwise("response"),
        F.lit(f"{CRLF}WARC-Record-ID: <"), _urn(page_id), F.lit(f">{CRLF}WARC-Date: {date}{CRLF}WARC-Target-URI: "),
        target, F.lit(f"{CRLF}WARC-Payload-Digest: sha1:"), sha1,
        F.when(is_revisit, F.concat(F.lit(f"{CRLF}WARC-Refers-To: <"), _urn(refers_to),
                                    F.lit(f">{CRLF}WARC-Profile: {REVISIT_PROFILE}"))).otherwise(""),
        F.lit(f"{CRLF}Content-Type: application/http; msgtype=response{CRLF}Content-Length: "),
        block.cast("string"), F.lit(CRLF * 2), http)


def write_archive(pages: DataFrame, path: str, min_revisit_bytes: int = 0, date: str = DEFAULT_DATE) -> None:
    """Write ``path/headers`` and ``path/payloads``.  Of equal payloads of at least
    ``min_revisit_bytes`` the largest page_id is the response, the others revisit it."""
    with shuffles_dropped(pages.sparkSession):
        _write_tables(_with_payload(pages), path, min_revisit_bytes, date)


def _write_tables(full: DataFrame, path: str, min_revisit_bytes: int, date: str) -> None:
    ids = full.select("page_id", "url", F.sha2("payload", 256).alias("digest"),
                      F.octet_length("payload").cast("long").alias("n_bytes"), base32_sha1(F.col("payload")).alias("sha1"))
    keep = stage(ids.groupBy(F.col("digest").alias("k_digest")).agg(F.max("page_id").alias("k_page")), "warc_keep")
    revisit = ~F.col("page_id").eqNullSafe(F.col("k_page")) & (F.col("n_bytes") >= min_revisit_bytes)
    headers = join_aggregate(ids, keep, F.col("digest") == F.col("k_digest"), staged=lambda df, _: df).select(
        "page_id", "digest", record_header(F.col("page_id"), F.col("url"), F.col("n_bytes"), F.col("sha1"),
                                           revisit, F.col("k_page"), date).alias("header"))
    headers.write.option("compression", "zstd").parquet(f"{path}/headers")
    stored = full.select("page_id", F.sha2("payload", 256).alias("digest"), "payload").join(
        keep, F.col("page_id").eqNullSafe(F.col("k_page")) & (F.col("digest") == F.col("k_digest"))
    ).select("digest", "payload")
    twice = ids.groupBy("page_id", "digest").count().where("count > 1").limit(1).count()
    if twice:  # repeated rows: their bytes too are stored once
        stored = stored.dropDuplicates(["digest"])
    stored.write.option("compression", "zstd").parquet(f"{path}/payloads")
    drop_staged(keep)


def _field(name: str) -> Column:
    return F.regexp_extract("header", f"\\r\\n{name}: ([^\\r]*)\\r\\n", 1)


def read_archive(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """Every record rebuilt by joining header and payload: (page_id, url, record_type,
    refers_to, payload, payload_bytes, payload_digest, header, verified)."""
    headers = spark.read.schema(f"page_id {id_type}, digest string, header string").parquet(f"{path}/headers")
    payloads = spark.read.schema("digest string, payload binary").parquet(f"{path}/payloads").select(
        F.col("digest").alias("p_digest"), "payload")

    def page(name: str) -> Column:
        return F.nullif(F.regexp_extract("header", f"\\r\\n{name}: <urn:page:([^>]*)>\\r\\n", 1), F.lit("")).try_cast(id_type)

    sha1 = base32_sha1(F.col("payload"))
    length = F.octet_length("payload").cast("long")
    http_length = F.regexp_extract("header", "\\r\\n\\r\\nHTTP/1.1 [^$]*?\\r\\nContent-Length: ([0-9]+)\\r\\n", 1)
    return headers.join(payloads, F.col("digest") == F.col("p_digest")).select(
        page("WARC-Record-ID").alias("page_id"), _field("WARC-Target-URI").alias("url"),
        _field("WARC-Type").alias("record_type"), page("WARC-Refers-To").alias("refers_to"),
        "payload", length.alias("payload_bytes"), sha1.alias("payload_digest"), "header",
        ((F.sha2("payload", 256) == F.col("digest")) & (F.concat(F.lit("sha1:"), sha1) == _field("WARC-Payload-Digest"))
         & (length == http_length.try_cast("long"))).alias("verified"))


def archive_path(spark: SparkSession) -> str:
    return app_scratch(spark, f"warc_{uuid.uuid4().hex}")


def export_warc(records: DataFrame, path: str) -> None:
    """Write records as ``.gz`` WARC files: header, payload of responses, two line ends."""
    body = F.when(F.col("record_type") == "response", F.decode("payload", "UTF-8")).otherwise("")
    records.select(F.concat("header", body)).write.option("lineSep", CRLF * 2).option("compression", "gzip").text(path)


def import_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of WARC files (read whole per file; ``export_warc`` after a
    ``repartition`` bounds their size): (record_type, record_id, refers_to, url, payload)."""
    head = re.compile(rb"([A-Za-z-]+): ([^\r]*)\r\n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for raw in b.column(0).to_pylist():
                raw = gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw
                rows, at = [], 0
                while raw.startswith(b"WARC/", at):
                    end = raw.index(b"\r\n\r\n", at) + 4
                    f = {k.decode().lower(): v.decode() for k, v in head.findall(raw, at, end)}
                    stop = end + int(f["content-length"])
                    rows.append((f["warc-type"], f["warc-record-id"], f.get("warc-refers-to"), f["warc-target-uri"],
                                 raw[raw.index(b"\r\n\r\n", end) + 4:stop]))
                    at = stop + 4
                if rows:
                    kinds = [pa.string()] * 4 + [pa.binary()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)],
                        ["record_type", "record_id", "refers_to", "url", "payload"])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(
        run, "record_type string, record_id string, refers_to string, url string, payload binary")
