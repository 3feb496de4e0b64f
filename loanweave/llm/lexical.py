"""Ranked lexical search over per-term blocks of similar documents.

Every document is the vector of its terms' impacts, weight times saturated
frequency, all 64-bit integers.  A posting list is cut into blocks of similar
documents: each member goes to the nearest of several members of the list by a
random projection of the vectors, and large clusters are cut by nearness.  A
block keeps the coordinatewise maximum of its vectors, an exact upper bound of
every score inside it.  A search reads an item's lists from the heaviest term to
the lightest.  A list's bound counts only this and the lighter terms, since
documents with a heavier one were met before, and a block is opened unless its
bound is below the k-th best score found; documents of opened blocks are scored
in full.  Nothing else is ever skipped, so the ranks are those of a scan.

Scale: texts are read once and reduced to the terms of the items (one staged row
per document, dealt evenly over tasks); corpus counts are two sums that combine before the shuffle.  Each
task cuts its documents into shards bounded by rows and postings, searches all
items in one shard after the other and carries its best scores along, which
prune the later shards; it sends k rows per item.  A term that all documents hold is a list of
each shard, never of one task.  A list is cut and summarised when the first item
reads it.  Items are taken in blocks of a bounded number of terms (what the
driver and each task hold), one pass over the texts a block.

Defined results: a null or empty text has no terms and is never found; items
without terms, or whose terms no document holds, get no rows; rows that share an
item_id (null too) are one item with the terms of all; rows that share a doc_id
rank each for itself; equal scores rank by doc_id, nulls last; an empty table gives no rows;
very long texts are read whole; other columns of the input are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanweave.llm.common import (byte_slices, drop_staged, lower_ascii, ship_package, span_hashes, stage, text_bytes)

TOP = 10
#: Documents of a block and most of one that a cluster is cut into.
BLOCK_DOCS = 32
#: Most rows and postings of a shard.
SHARD_DOCS = 8192
SHARD_POSTINGS = 1 << 21
#: Documents that a task searches, on average: best scores prune best when carried far, but tasks must stay short.
TASK_DOCS = 16384
#: Most (item, term) pairs of a block of items.
ITEM_PAIRS = 1 << 20
SKETCH = 16
#: Terms of an item, from the list's own on, whose maxima a block keeps; beyond
#: them the shard's maximum stands in the bound, which stays an upper one.
PARTNERS = 256
_NO_ID = np.iinfo(np.int64).max

#: Bytes of terms: digits, letters and everything beyond ASCII.
_TERM = np.zeros(256, bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def terms_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit fingerprint of every term of every text, and each one's row."""
    data, starts = text_bytes(column)
    edge = np.flatnonzero(np.diff(_TERM[data].view(np.int8), prepend=0, append=0))
    return (span_hashes(lower_ascii(data), edge[0::2], edge[1::2]),
            np.searchsorted(starts, edge[0::2], side="right") - 1)


def item_terms(items: DataFrame, key: str = "item_id") -> DataFrame:
    """(key, term bigint, q bigint): each item's terms and how often it holds them."""
    frame = items.select(F.col(key).cast("string").alias("item"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in byte_slices(b, 1):
                h, row = terms_of(part.column(1))
                if len(h):
                    yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row)), pa.array(h.view(np.int64))], ["item", "term"])

    return frame.mapInArrow(run, "item string, term bigint").groupBy("item", "term").agg(F.count("*").alias("q"))


def forward_index(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """(doc_id, n, terms array<int>, tfs array<int>) of every document that holds a term:
    its length in terms and its terms as positions in the sorted ``vocabulary``."""
    frame = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = max(1, len(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in byte_slices(b, 1):
                h, row = terms_of(part.column(1))
                n = np.bincount(row, minlength=part.num_rows)
                at = np.searchsorted(vocabulary, h)
                known = at < len(vocabulary)
                known[known] = vocabulary[at[known]] == h[known]
                pair, tf = np.unique(row[known] * size + at[known], return_counts=True)
                ends = np.concatenate(([0], np.cumsum(np.bincount(pair // size, minlength=part.num_rows)))).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(v.astype(np.int32))) for v in (pair % size, tf)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n), *lists],
                                                 ["doc_id", "n", "terms", "tfs"]).filter(pa.array(n > 0))

    return frame.mapInArrow(run, "doc_id bigint, n bigint, terms array<int>, tfs array<int>")


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Shard:
    """Documents of one shard with their impacts, and the blocks of the lists read so far."""

    def __init__(self, ids: np.ndarray, ptr: np.ndarray, terms: np.ndarray, impacts: np.ndarray, order: np.ndarray,
                 partners: dict[int, np.ndarray], block_docs: int):
        """``order[t]``: place of term t from heaviest to lightest; ``partners[t]``: sorted
        terms, t among them, that share an item with t and follow it there (see PARTNERS)."""
        self.ids, self.ptr, self.terms, self.impacts = ids, ptr, terms, impacts
        self.order, self.partners, self.block_docs = order, partners, block_docs
        n_terms = len(order)
        doc = np.repeat(np.arange(len(ids)), np.diff(ptr))
        by_term = np.argsort(terms, kind="stable")
        self.posting_docs = doc[by_term]
        self.posting_ptr = np.concatenate(([0], np.cumsum(np.bincount(terms, minlength=n_terms))))
        self.most = np.zeros(n_terms, np.int64)
        np.maximum.at(self.most, terms, impacts)
        axes = np.random.default_rng(7).choice(np.array([-1, 1], np.float32), (n_terms, SKETCH))
        self.sketch = np.zeros((len(ids), SKETCH), np.float32)
        for at in range(0, len(ids), 1024):
            a, z = ptr[at], ptr[min(at + 1024, len(ids))]
            part = axes[terms[a:z]] * impacts[a:z, None].astype(np.float32)
            held = np.flatnonzero(np.diff(ptr[at:at + 1025]))
            if len(held):
                self.sketch[at + held] = np.add.reduceat(part, ptr[at + held] - a)
        self.sketch /= np.maximum(np.linalg.norm(self.sketch, axis=1, keepdims=True), 1e-30)
        self.column = np.full(n_terms, -1)
        self.lists: dict[int, tuple] = {}
        self.blocks_read = self.blocks_opened = 0

    def rows(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of all entries of ``docs``, and where each one's entries start among them."""
        length = self.ptr[docs + 1] - self.ptr[docs]
        start = np.cumsum(length) - length
        return np.arange(length.sum()) + np.repeat(self.ptr[docs] - start, length), start

    def blocks(self, term: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The list of ``term``: documents block by block, block bounds, and each
        block's maximum at every partner of the term (blocks x partners)."""
        if term in self.lists:
            return self.lists[term]
        docs = self.posting_docs[self.posting_ptr[term]:self.posting_ptr[term + 1]]
        n_seeds = -(-len(docs) // self.block_docs)
        if n_seeds > 1:
            seeds = self.sketch[docs[np.linspace(0, len(docs) - 1, n_seeds).astype(np.int64)]]
            near = self.sketch[docs] @ seeds.T
            cluster = near.argmax(axis=1)
            by = np.lexsort((-near[np.arange(len(docs)), cluster], cluster))
            docs, cluster = docs[by], cluster[by]
            place = np.arange(len(docs)) - np.searchsorted(cluster, cluster)
            cuts = np.flatnonzero(np.diff(cluster, prepend=-1) | (place % self.block_docs == 0))
        else:
            cuts = np.zeros(1, np.int64)
        bounds = np.append(cuts, len(docs))
        partners = self.partners[term]
        at, start = self.rows(docs)
        block = np.repeat(np.repeat(np.arange(len(cuts)), np.diff(bounds)), self.ptr[docs + 1] - self.ptr[docs])
        self.column[partners] = np.arange(len(partners))
        col = self.column[self.terms[at]]
        self.column[partners] = -1
        has = col >= 0
        summary = np.zeros((len(cuts), len(partners)), np.int64)
        np.maximum.at(summary.ravel(), block[has] * len(partners) + col[has], self.impacts[at[has]])
        self.lists[term] = docs, bounds, summary
        return self.lists[term]

    def search(self, terms: np.ndarray, q: np.ndarray, best: tuple[np.ndarray, np.ndarray], top: int,
               dense: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best (scores, doc ids) of one item, whose ``terms`` go from heaviest to lightest, given
        the best so far.  ``dense`` (zeros) and ``seen`` (false) are lent and given back clean."""
        reach = np.cumsum((q * self.most[terms])[::-1])[::-1]
        dense[terms] = q
        touched = []
        for j, term in enumerate(terms):
            floor = best[0][-1] if len(best[0]) == top else 1
            if reach[j] < floor:
                break
            if not self.most[term]:
                continue
            docs, bounds, summary = self.blocks(term)
            far = j + PARTNERS
            cols = np.searchsorted(self.partners[term], terms[j:far])
            limit = summary[:, cols] @ q[j:far] + (reach[far] if far < len(terms) else 0)
            line = np.argsort(-limit, kind="stable")
            self.blocks_read += len(line)
            at, step = 0, 4
            while at < len(line):
                floor = best[0][-1] if len(best[0]) == top else 1
                now = line[at:at + step]
                now = now[limit[now] >= floor]  # an equal score may still win by its doc_id
                if not len(now):
                    break  # bounds fall along the line
                self.blocks_opened += len(now)
                length = bounds[now + 1] - bounds[now]
                inside = np.arange(length.sum()) + np.repeat(bounds[now] - np.cumsum(length) + length, length)
                met = docs[inside]
                met = met[~seen[met]]
                if len(met):
                    seen[met] = True
                    touched.append(met)
                    places, start = self.rows(met)
                    score = np.add.reduceat(self.impacts[places] * dense[self.terms[places]], start)
                    good = score >= floor
                    if good.any():
                        scores = np.concatenate((best[0], score[good]))
                        ids = np.concatenate((best[1], self.ids[met[good]]))
                        keep = np.lexsort((ids, -scores))[:top]
                        best = scores[keep], ids[keep]
                at, step = at + step, step * 2
        dense[terms] = 0
        for met in touched:
            seen[met] = False
        return best


def _partners(items: list[tuple[np.ndarray, np.ndarray]], order: np.ndarray) -> dict[int, np.ndarray]:
    found: dict[int, list] = {}
    for terms, _ in items:
        for j, t in enumerate(terms):
            found.setdefault(int(t), []).append(terms[j:j + PARTNERS])
    return {t: np.unique(np.concatenate(parts)) for t, parts in found.items()}


def _search_block(docs: DataFrame, pairs: list, top: int, block_docs: int, shard_docs: int) -> DataFrame | None:
    """Best rows of the items in ``pairs`` ((item, term, q) rows): (item, doc_id, score)."""
    vocabulary = np.unique(np.array([r["term"] for r in pairs], np.int64).view(np.uint64))
    index = stage(forward_index(docs, vocabulary), "lexical_forward")
    total = index.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    if not total["docs"]:
        drop_staged(index)
        return None
    n_docs, n_terms = total["docs"], total["terms"]
    weight = np.zeros(len(vocabulary), np.int64)
    for r in index.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df")).collect():
        weight[r["t"]] = term_weight(n_docs, r["df"])  # one row per term of the items
    order = np.empty(len(vocabulary), np.int64)
    order[np.lexsort((np.arange(len(vocabulary)), -weight))] = np.arange(len(vocabulary))
    grouped: dict = {}
    for r in pairs:
        grouped.setdefault(r["item"], []).append((r["term"], r["q"]))
    names, items = list(grouped), []
    for name in names:
        t = np.searchsorted(vocabulary, np.array([x[0] for x in grouped[name]], np.int64).view(np.uint64))
        q = np.array([x[1] for x in grouped[name]], np.int64)
        by = np.argsort(order[t])
        by = by[weight[t[by]] > 0]
        items.append((t[by], q[by]))
    partners = _partners(items, order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(items)
        dense, seen = np.zeros(len(vocabulary), np.int64), np.zeros(0, bool)
        for b in batches:
            ptr = np.concatenate(([0], np.cumsum(np.diff(b.column(2).offsets.to_numpy())))).astype(np.int64)
            ids = b.column(0).fill_null(_NO_ID).to_numpy()
            n, terms = b.column(1).to_numpy(), b.column(2).flatten().to_numpy().astype(np.int64)
            tf = b.column(3).flatten().to_numpy().astype(np.int64)
            room = np.repeat(25 + (75 * n * n_docs) // n_terms, np.diff(ptr))
            impact = weight[terms] * ((1000000000 * tf) // (1000 * tf + 8 * room))
            at = 0
            while at < b.num_rows:
                to = min(at + shard_docs, max(at + 1, int(np.searchsorted(ptr, ptr[at] + SHARD_POSTINGS, side="right")) - 1), b.num_rows)
                a, z = ptr[at], ptr[to]
                live = np.flatnonzero(impact[a:z]) + a
                cut = np.concatenate(([0], np.cumsum(np.bincount(np.searchsorted(ptr, live, side="right") - 1 - at, minlength=to - at))))
                shard = Shard(ids[at:to], cut, terms[live], impact[live], order, partners, block_docs)
                if len(seen) < to - at:
                    seen = np.zeros(to - at, bool)
                for k, (t, q) in enumerate(items):
                    best[k] = shard.search(t, q, best[k], top, dense, seen)
                at = to
        found = [k for k, (s, _) in enumerate(best) if len(s)]
        if found:
            yield pa.RecordBatch.from_arrays(
                [pa.array([names[k] for k in found for _ in best[k][0]], pa.string()),
                 pa.array([None if d == _NO_ID else int(d) for k in found for d in best[k][1]], pa.int64()),
                 pa.array(np.concatenate([best[k][0] for k in found]))], ["item", "doc_id", "score"])

    dealt = index.where(F.size("terms") > 0).repartition(-(-n_docs // TASK_DOCS))  # long and short documents mixed
    best = dealt.mapInArrow(run, "item string, doc_id bigint, score bigint")
    line = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    out = stage(best.withColumn("rank", F.row_number().over(line)).where(F.col("rank") <= top), "lexical_best")
    drop_staged(index)
    return out


def search(items: DataFrame, docs: DataFrame, top: int = TOP, key: str = "item_id", item_pairs: int = ITEM_PAIRS,
           block_docs: int = BLOCK_DOCS, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """(key, rank, doc_id, score): the ``top`` documents with the highest score above 0 for each item."""
    spark = items.sparkSession
    ship_package(spark)
    kind = items.schema[key].dataType.simpleString()
    wanted = stage(item_terms(items, key), "lexical_items")
    n_blocks = max(1, -(-wanted.count() // item_pairs))
    block = F.pmod(F.xxhash64(F.coalesce("item", F.lit("\u0000"))), F.lit(n_blocks))
    parts = []
    for k in range(n_blocks):
        pairs = wanted.where(block == k).collect()  # about ``item_pairs`` rows, an item whole
        found = _search_block(docs, pairs, top, block_docs, shard_docs) if pairs else None
        if found is not None:
            parts.append(found)
    drop_staged(wanted)
    if not parts:
        return spark.createDataFrame([], f"{key} {kind}, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, parts).select(F.col("item").cast(kind).alias(key), "rank", "doc_id", "score")
