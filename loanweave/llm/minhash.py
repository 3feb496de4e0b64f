"""Near-duplicate documents: MinHash bands, sequential Bayesian pruning of
candidates, exact verification.

1. One pass hashes each text's set of word shingles, folds it to ``HASHES``
   minima, ``BANDS`` band keys and a set fingerprint.  Equal sets collapse to
   the smallest doc_id, so groups of exact copies cost nothing further.
2. Documents that share a band key form a bucket; each is paired with the
   bucket's smallest document only (a star, so no pairs within a group).
3. A pair's signatures are compared batch by batch.  With a uniform prior, m
   agreements among n hashes leave P(similarity >= threshold) =
   P(Binomial(n + 1, threshold) <= m); a pair is dropped once that is below
   ``MISS``.  Survivors are verified exactly on their full shingle sets.
4. Linked documents are contracted to components.  Where a bucket still holds
   several components, the members outside the smallest document's component are
   compared with all members of other components: small buckets by a join on
   the key and step 3, larger ones in blocks of ``BLOCK`` members inside tasks,
   pruned and verified there.  Pairs within a component, nearly all of a group
   of copies, are never made.  Components of all links are then final.

At similarity 0.8 a pair shares no band with probability (1 - 0.8**5)**32 =
3e-6, less for more similar ones, and pruning misses it with at most ``MISS``
per batch.  Shingles stand for themselves by 64-bit fingerprints.

Texts are moved once: those of documents in any shared bucket are written
bucketed by doc_id, so later joins move only pairs.  Every stage ends in a table
in the shared folder.

Defined results: a null or empty text has no shingles and is linked with
nothing; fewer words than a shingle make one shingle; rows that share a doc_id
are one node and each gives a row; a null doc_id is linked with nothing and
kept; other columns of the input are not read; an empty table gives no rows;
very long texts are shingled and verified whole.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanweave.llm.common import (byte_slices, connected_components, drop_staged, lower_ascii, mix64, return_memory, ship_package,
                                  short_batches, span_hashes, stage, text_bytes, tidy, word_spans)
from loanweave.session import scratch_path

SHINGLE = 5
PERCENT = 80
BANDS, ROWS = 32, 5
#: Text of a bucket of the written documents, bytes taken for a word, and Spark's own limit on buckets.
BUCKET_BYTES = 128 * 1024 * 1024
WORD_BYTES = 8
MOST_BUCKETS = 100_000
HASHES = 288
BATCH = 32
MISS = 1e-7
BLOCK = 512
SMALL_BUCKET = 64
#: Rows of an Arrow batch, and bytes of texts that are shingled at a time (some ten times that as arrays).
BATCH_ROWS = 1000
SLICE_BYTES = 1 << 19

_rng = np.random.default_rng(77)
_MULT = _rng.integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(column: pa.Array, k: int) -> list[np.ndarray]:
    """Distinct shingle fingerprints of every text, sorted."""
    data, starts = text_bytes(column)
    data = lower_ascii(data)
    ws, we = word_spans(data)
    h = span_hashes(data, ws, we)
    first = np.searchsorted(ws, starts)
    n = max(0, len(h) - k + 1)
    gram = np.full(n, np.uint64(k), np.uint64)
    for i in range(k):
        gram = mix64(gram * np.uint64(0x9E3779B97F4A7C15) + h[i:n + i])
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= k:
            out.append(np.unique(gram[a:b - k + 1]))
        elif b > a:
            one = np.full(1, np.uint64(b - a), np.uint64)
            for x in h[a:b]:
                one = mix64(one * np.uint64(0x9E3779B97F4A7C15) + x)
            out.append(one)
        else:
            out.append(np.empty(0, np.uint64))
    return out


def _minima(s: np.ndarray) -> np.ndarray:
    low = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(s), 256):
        np.minimum(low, (_MULT[:, None] * s[None, at:at + 256]).min(axis=1), out=low)
    return low


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, n_shingles, fp1, fp2, bands, sig) of every row."""
    frame = docs.select("doc_id", F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in byte_slices(b, 1, SLICE_BYTES):
                sets = shingle_sets(part.column(1), k)
                low = np.stack([_minima(s) for s in sets])
                key = np.repeat(np.arange(BANDS, dtype=np.uint64)[None, :], len(sets), axis=0)
                for r in range(ROWS):
                    key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + low[:, r:BANDS * ROWS:ROWS])
                sig = (mix64(low) & np.uint64(0xFF)).astype(np.uint8)
                empty = np.array([len(s) == 0 for s in sets])
                offsets = np.concatenate(([0], np.cumsum(np.where(empty, 0, BANDS)))).astype(np.int32)
                fp = [(int(mix64(s).sum(dtype=np.uint64)), int(np.bitwise_xor.reduce(mix64(s * np.uint64(0xD6E8FEB86659FD93)))))
                      if len(s) else (0, 0) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(s) for s in sets], pa.int64()),
                     *(pa.array(np.array([f[i] for f in fp], np.uint64).view(np.int64)) for i in (0, 1)),
                     pa.ListArray.from_arrays(offsets, pa.array(key[~empty].ravel().view(np.int64))),
                     pa.array([row.tobytes() for row in sig], pa.binary())],
                    ["doc_id", "n_shingles", "fp1", "fp2", "bands", "sig"])

    return frame.mapInArrow(tidy(run), f"doc_id {frame.schema['doc_id'].dataType.simpleString()}, n_shingles bigint, "
                                 "fp1 bigint, fp2 bigint, bands array<bigint>, sig binary")


def least_matches(percent: int, miss: float = MISS) -> np.ndarray:
    """For each batch: fewer agreements so far leave the threshold a posterior under ``miss``.
    Signatures keep 8 bits, so unequal minima agree once in 256."""
    t = percent / 100
    t += (1 - t) / 256
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        total, m = 0.0, -1
        while True:
            j = m + 1
            total += math.exp(math.lgamma(n + 2) - math.lgamma(j + 1) - math.lgamma(n + 2 - j)
                              + j * math.log(t) + (n + 1 - j) * math.log1p(-t))
            if total >= miss:
                break
            m = j
        out.append(m + 1)
    return np.array(out)


def similar_enough(a: np.ndarray, b: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Sequential test of aligned signature rows: True where a pair survives every batch."""
    alive = np.arange(len(a))
    count = np.zeros(len(a), np.int64)
    for k, need in enumerate(least):
        cut = slice(k * BATCH, (k + 1) * BATCH)
        count[alive] += (a[alive, cut] == b[alive, cut]).sum(axis=1)
        alive = alive[count[alive] >= need]
    ok = np.zeros(len(a), bool)
    ok[alive] = True
    return ok


def _sig_matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, HASHES)


class _Bucketed:
    """Documents in shared buckets, written once, bucketed by doc_id."""

    def __init__(self, frame: DataFrame, text_bytes: int):
        """A bucket is for about BUCKET_BYTES of the ``text_bytes`` of all texts."""
        spark = frame.sparkSession
        self.spark, self.name = spark, f"llm_minhash_{uuid.uuid4().hex}"
        self.path = scratch_path(spark, "llm", self.name)
        n = min(MOST_BUCKETS, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-text_bytes // BUCKET_BYTES)))
        (frame.write.format("parquet").option("compression", "zstd").option("path", self.path)
         .bucketBy(n, "doc_id").saveAsTable(self.name))
        self.schema = frame.schema

    def by_bucket(self, *cols: str) -> DataFrame:
        """Joins on doc_id leave this side where it is."""
        return self.spark.table(self.name).select(*cols)

    def plain(self, *cols: str) -> DataFrame:
        """For joins with hot keys: shuffled, so that AQE can split them."""
        return self.spark.read.schema(self.schema).parquet(self.path).select(*cols)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _with_both(pairs: DataFrame, docs: _Bucketed, *cols: str) -> DataFrame:
    left = docs.plain("doc_id", *cols).select(F.col("doc_id").alias("id_a"), *[F.col(c).alias(f"{c}_a") for c in cols])
    right = docs.by_bucket("doc_id", *cols).select(F.col("doc_id").alias("id_b"), *[F.col(c).alias(f"{c}_b") for c in cols])
    return (pairs.join(left, F.col("a") == F.col("id_a")).drop("id_a")
            .join(right, F.col("b") == F.col("id_b")).drop("id_b"))


def prune_pairs(pairs: DataFrame, docs: _Bucketed, percent: int) -> DataFrame:
    """Candidate pairs that survive the sequential signature test."""
    least = least_matches(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = similar_enough(_sig_matrix(b.column("sig_a")), _sig_matrix(b.column("sig_b")), least)
            yield b.select(["a", "b"]).filter(pa.array(ok))

    both = _with_both(pairs, docs, "sig", "n_shingles").where(
        f"100 * least(n_shingles_a, n_shingles_b) >= {percent} * greatest(n_shingles_a, n_shingles_b)")
    return both.select("a", "b", "sig_a", "sig_b").mapInArrow(tidy(run), pairs.schema)


def verify_pairs(pairs: DataFrame, docs: _Bucketed, k: int, percent: int) -> DataFrame:
    """Pairs whose full shingle sets are similar enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in (p for q in byte_slices(b, 2, SLICE_BYTES) for p in byte_slices(q, 3, SLICE_BYTES)):
                ok = []
                for x, y in zip(shingle_sets(part.column("text_a"), k), shingle_sets(part.column("text_b"), k)):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    ok.append(len(x) > 0 and 100 * both >= percent * (len(x) + len(y) - both))
                yield part.select(["a", "b"]).filter(pa.array(ok))

    return _with_both(pairs, docs, "text").select("a", "b", "text_a", "text_b").mapInArrow(tidy(run), pairs.schema)


def _confirmed(pairs: DataFrame, docs: _Bucketed, k: int, percent: int) -> DataFrame:
    survivors = stage(prune_pairs(pairs, docs, percent), "minhash_survivors")
    links = stage(verify_pairs(survivors, docs, k, percent), "minhash_links")
    drop_staged(survivors)
    return links


def _open_buckets(hits: DataFrame, links: DataFrame) -> DataFrame:
    """Members (key, x, cx, outside, n, n_out) of buckets with untested pairs across components."""
    comp = stage(connected_components(links), "minhash_comp")
    cx = comp.select(F.col("node").alias("x1"), F.col("component_id").alias("c1"))
    cp = comp.select(F.col("node").alias("x2"), F.col("component_id").alias("c2"))
    at = (hits.join(cx, F.col("x") == F.col("x1"), "left").join(cp, F.col("pivot") == F.col("x2"), "left")
          .select("key", "x", "pivot", F.coalesce("c1", "x").alias("cx"), F.coalesce("c2", "pivot").alias("cp"))
          .withColumn("outside", F.col("cx") != F.col("cp")))
    at = stage(at, "minhash_at")
    keys = at.groupBy("key").agg(F.count("*").alias("n"), F.sum(F.col("outside").cast("long")).alias("n_out")).where(
        "n_out >= 2 or (n_out = 1 and n >= 3)").select(F.col("key").alias("k2"), "n", "n_out")
    return stage(at.join(keys, F.col("key") == F.col("k2")).drop("k2"), "minhash_open")


def _small_pairs(members: DataFrame) -> DataFrame:
    few = members.where(F.col("n") <= SMALL_BUCKET)
    a = few.where("outside").select("key", F.col("x").alias("a"), F.col("cx").alias("ca"))
    b = few.where("x != pivot").select("key", F.col("x").alias("b"), F.col("cx").alias("cb"), "outside")
    return (a.join(b, "key").where("ca != cb and (not outside or a < b)")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def _block_links(members: DataFrame, docs: _Bucketed, k: int, percent: int) -> DataFrame:
    """Links across components in large buckets: blocks of signatures are compared
    inside tasks and survivors verified there, unless links found in the block have
    joined their components already; only links that join components come out."""
    least = least_matches(percent)
    many = members.where(F.col("n") > SMALL_BUCKET)
    out_blocks = F.ceil(F.col("n_out") / BLOCK).cast("int")
    all_blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    h = F.xxhash64("x")
    row = many.where("outside").select(
        "key", "x", "cx", "outside", F.lit(True).alias("probe"), F.pmod(h, out_blocks).cast("int").alias("r"),
        F.explode(F.sequence(F.lit(0), all_blocks - 1)).alias("m"))
    col = many.where("x != pivot").select(
        "key", "x", "cx", "outside", F.lit(False).alias("probe"),
        F.explode(F.sequence(F.lit(0), out_blocks - 1)).alias("r"), F.pmod(h, all_blocks).cast("int").alias("m"))
    sig = docs.by_bucket("doc_id", "sig", "n_shingles", "bands", "text").withColumnRenamed("doc_id", "id")
    both = row.unionByName(col).join(sig, F.col("x") == F.col("id")).drop("id")
    id_type = members.schema["x"].dataType.simpleString()

    def run(key: tuple, t: pa.Table) -> pa.Table:
        band_key = key[0].as_py()
        probe = t["probe"].to_numpy()
        x, cx, out = t["x"].to_numpy(), t["cx"].to_numpy(), t["outside"].to_numpy()
        n = t["n_shingles"].to_numpy()
        sig = _sig_matrix(t["sig"].combine_chunks())
        bands = t["bands"].combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
        texts = t["text"].combine_chunks()
        rows, cols = np.flatnonzero(probe), np.flatnonzero(~probe)
        survivors = []
        for i in rows.tolist():
            j = cols[(cx[cols] != cx[i]) & (~out[cols] | (x[cols] > x[i]))
                     & (100 * np.minimum(n[cols], n[i]) >= percent * np.maximum(n[cols], n[i]))]
            if len(j):  # a pair is taken in the first band that its members share
                j = j[bands[i][(bands[j] == bands[i]).argmax(axis=1)] == band_key]
            if len(j):
                j = j[similar_enough(np.broadcast_to(sig[i], (len(j), HASHES)), sig[j], least)]
            if len(j):
                agree = (sig[j] == sig[i]).sum(axis=1)
                survivors.append((i, j[np.argsort(-agree, kind="stable")]))
        need = np.unique(np.concatenate([np.concatenate(([i], j)) for i, j in survivors])) if survivors else rows[:0]
        sets = dict(zip(need.tolist(), shingle_sets(texts.take(pa.array(need)), k)))
        root = {c: c for c in cx.tolist()}

        def find(c):
            while root[c] != c:
                root[c] = root[root[c]]
                c = root[c]
            return c

        found = []
        for i, js in survivors:
            for m in js.tolist():
                a, b = find(cx[i]), find(cx[m])
                if a != b:
                    both = len(np.intersect1d(sets[i], sets[m], assume_unique=True))
                    if 100 * both >= percent * (n[i] + n[m] - both):
                        root[max(a, b)] = min(a, b)
                        found.append((min(x[i], x[m]), max(x[i], x[m])))
        del sets, sig, bands, survivors
        return_memory()
        return pa.table({"a": pa.array([f[0] for f in found], t["x"].type),
                         "b": pa.array([f[1] for f in found], t["x"].type)})

    return both.groupBy("key", "r", "m").applyInArrow(run, f"a {id_type}, b {id_type}")


def near_duplicates(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row."""
    ship_package(docs.sparkSession)
    with short_batches(docs.sparkSession, BATCH_ROWS):  # all Python runs in jobs that end here
        return _near_duplicates(docs, k, percent)


def _near_duplicates(docs: DataFrame, k: int, percent: int) -> DataFrame:
    sigs = stage(signatures(docs, k), "minhash_sigs")
    usable = sigs.where("n_shingles > 0 and doc_id is not null")
    classes = usable.groupBy("fp1", "fp2", F.col("n_shingles").alias("n")).agg(F.min("doc_id").alias("rep"))
    classes = stage(classes.select(F.col("fp1").alias("f1"), F.col("fp2").alias("f2"), "n", "rep"), "minhash_classes")
    reps = usable.select("doc_id", "bands").join(classes.select("rep"), F.col("doc_id") == F.col("rep"), "left_semi")
    members = reps.select(F.explode("bands").alias("key"), F.col("doc_id").alias("x"))
    shared = members.groupBy(F.col("key").alias("k2")).agg(F.min("x").alias("pivot"), F.max("x").alias("top")).where(
        "pivot != top").select("k2", "pivot")
    hits = stage(members.join(shared, F.col("key") == F.col("k2")).select("key", "x", "pivot"), "minhash_hits")
    near = usable.select("doc_id", "n_shingles", "bands", "sig").join(
        hits.select(F.col("x").alias("doc_id")).distinct(), "doc_id")
    # A distinct shingle begins at a word of its own, so this is about the bytes of all texts.
    total_bytes = WORD_BYTES * (usable.agg(F.sum("n_shingles")).first()[0] or 0)
    texts = docs.select(F.col("doc_id").alias("d"), F.col("text").cast("string").alias("text"))
    table = _Bucketed(near.join(texts, F.col("doc_id") == F.col("d")).drop("d"), total_bytes)
    stars = hits.where("x != pivot").select(F.col("pivot").alias("a"), F.col("x").alias("b")).distinct()
    links = _confirmed(stars, table, k, percent)
    still = _open_buckets(hits, links)
    more = _confirmed(stage(_small_pairs(still), "minhash_rest"), table, k, percent).unionByName(
        stage(_block_links(still, table, k, percent), "minhash_block_links"))
    member = usable.select("doc_id", "fp1", "fp2", "n_shingles").join(
        classes, (F.col("fp1") == F.col("f1")) & (F.col("fp2") == F.col("f2")) & (F.col("n_shingles") == F.col("n"))
    ).select("doc_id", "n_shingles", "rep")
    # Rows that share a doc_id are one node, whatever their texts.
    again = usable.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("again"))
    same = member.join(again, F.col("doc_id") == F.col("again")).select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    comp = stage(connected_components(links.unionByName(more).unionByName(same)), "minhash_comp")
    table.drop()
    lone = sigs.where("n_shingles = 0 or doc_id is null").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"))
    linked = member.join(comp, F.col("rep") == F.col("node"), "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "rep").alias("component_id"))
    return linked.withColumn("kept", F.col("doc_id") == F.col("component_id")).unionByName(lone)
