"""Byte-level BPE encoding and decoding by corpus-level merge replay.

Spark deals out blocks of documents (Arrow batches).  For each block the
distinct pieces of the split pattern that the task has not met yet form a
small corpus: one long token array with neighbour links.  An inverted index
maps every mergeable token pair (named by the rank of its joined bytes) to
the positions where it stands.  Ranks are replayed from the lowest up; each
merge touches only its own position and the pairs on either side, whose new
ranks are added to the index.  Documents are then read off piece by piece.
Nothing is shuffled, and memory holds one block plus a bounded piece table.

Defined results: a null or empty text has no ids and decodes to nothing;
special-token strings are ordinary text; every row gives one row, repeated
rows repeated rows; other columns of the input are not read; an empty table gives
no rows; a very long text is encoded whole, and its distinct pieces must fit a
task.  Equal ranks cannot tie: a rank names one pair of bytes.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanweave.llm.common import ship_package

DEFAULT_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
# Entries of the table of encoded pieces a task keeps between blocks.
MAX_PIECES = 600_000
# Documents whose pieces are replayed together.
BLOCK_ROWS = 5_000


def load_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}


class CorpusBpe:
    """Encoder state of one task."""

    # Ranks that stand at fewer places are replayed one by one.
    FEW = 12

    def __init__(self, ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN):
        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        self.vocab = {i: b for b, i in ranks.items()}
        self.byte_ids = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        # Every way to cut a token into two tokens: left id << 32 | right id -> rank.
        cuts = {}
        for whole, r in ranks.items():
            for k in range(1, len(whole)):
                left, right = ranks.get(whole[:k]), ranks.get(whole[k:])
                if left is not None and right is not None:
                    cuts[left << 32 | right] = r
        self.pair_rank = cuts
        self.pair_keys = np.array(sorted(cuts), np.int64)
        self.pair_vals = np.array([cuts[k] for k in self.pair_keys.tolist()], np.int64)
        self.pieces: dict[str, tuple[int, ...]] = {}

    def _pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where the two don't merge or a piece ends."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[at] == key) & (a >= 0) & (b >= 0), self.pair_vals[at], -1)

    def learn_pieces(self, pieces: Iterable[str]) -> None:
        """Replay the merges over all pieces at once and store their ids."""
        names: list[str] = []
        raws: list[bytes] = []
        for p in pieces:
            raw = p.encode("utf-8")
            whole = self.ranks.get(raw)
            if whole is not None:
                self.pieces[p] = (whole,)
            else:
                names.append(p)
                raws.append(raw)
        if not names:
            return
        sizes = np.array([len(r) for r in raws], np.int64)
        heads = np.concatenate(([0], np.cumsum(sizes + 1)))[:-1]
        n = int(sizes.sum()) + len(raws)
        tok = np.full(n, -1, np.int64)  # -1 ends a piece, -2 was merged into its left neighbour
        inside = np.ones(n, bool)
        inside[heads + sizes] = False
        tok[inside] = self.byte_ids[np.frombuffer(b"".join(raws), np.uint8)]
        nxt = np.arange(1, n + 1)
        prv = np.arange(-1, n - 1)
        index: dict[int, list] = {}  # rank of a pair -> arrays or numbers of its positions
        heap: list[int] = []

        def add(ranks: np.ndarray, spots: np.ndarray) -> None:
            keep = ranks >= 0
            ranks, spots = ranks[keep], spots[keep]
            order = np.argsort(ranks, kind="stable")
            ranks, spots = ranks[order], spots[order]
            cut = np.flatnonzero(np.diff(ranks)) + 1
            for r, part in zip(ranks[np.concatenate(([0], cut))].tolist() if len(ranks) else (),
                               np.split(spots, cut)):
                add_to(r, part)

        def add_to(r: int, part) -> None:
            if r in index:
                index[r].append(part)
            else:
                index[r] = [part]
                heapq.heappush(heap, r)

        add(self._pair_ranks(tok[:-1], tok[1:]), np.arange(n - 1))
        while heap:
            r = heapq.heappop(heap)
            spots = np.unique(np.concatenate([np.atleast_1d(x) for x in index.pop(r)]))
            if len(spots) < self.FEW or not self._merge_many(r, spots, tok, nxt, prv, add):
                self._merge_each(r, spots.tolist(), tok, nxt, prv, add_to)
        left = np.flatnonzero(tok >= 0)
        ids = tok[left].tolist()
        cut = np.searchsorted(left, heads).tolist() + [len(ids)]
        for k, p in enumerate(names):
            self.pieces[p] = tuple(ids[cut[k]:cut[k + 1]])

    def _merge_many(self, r, spots, tok, nxt, prv, add) -> bool:
        """Merge rank ``r`` at all its places at once; False (nothing done) if
        that would bring up a lower rank, which must go first."""
        a = tok[spots]
        j = nxt[spots]
        j = np.where(j < len(tok), j, 0)
        ok = (a >= 0) & (self._pair_ranks(a, tok[j]) == r)
        i, j = spots[ok], j[ok]
        if not len(i):
            return True
        if len(i) > 1 and (chained := np.concatenate(([False], i[1:] == j[:-1]))).any():
            # runs of one token: every second overlapping pair merges, from the left
            at = np.arange(len(i))
            first = np.maximum.accumulate(np.where(chained, 0, at))
            keep = (at - first) % 2 == 0
            i, j = i[keep], j[keep]
        q = nxt[j]
        rr = np.full(len(i), r)
        early = self._pair_ranks(rr, tok[q])
        h = np.maximum(prv[i], 0)
        early_left = self._pair_ranks(np.where(prv[i] >= 0, tok[h], -1), rr)
        if ((early >= 0) & (early < r)).any() or ((early_left >= 0) & (early_left < r)).any():
            return False
        twin = self.pair_rank.get(r << 32 | r, -1)
        if 0 <= twin < r:
            return False
        tok[i] = r  # the id of a merged token is its rank
        tok[j] = -2
        nxt[i] = q
        prv[q] = i
        h = prv[i]
        spot = np.concatenate((i, h[h >= 0]))
        mate = np.concatenate((q, i[h >= 0]))
        add(self._pair_ranks(tok[spot], tok[mate]), spot)
        return True

    def _merge_each(self, r, spots, tok, nxt, prv, add_to) -> None:
        rank = self.pair_rank.get
        for k, i in enumerate(spots):
            a = int(tok[i])
            if a < 0:
                continue  # merged away
            j = int(nxt[i])
            b = int(tok[j])
            if b < 0 or rank(a << 32 | b) != r:
                continue
            tok[i], tok[j] = r, -2
            q = int(nxt[j])
            nxt[i] = q
            prv[q] = i
            low = False
            c = int(tok[q])
            if c >= 0 and (s := rank(r << 32 | c, -1)) >= 0:
                add_to(s, i)
                low = s < r
            h = int(prv[i])
            if h >= 0 and (d := int(tok[h])) >= 0 and (s := rank(d << 32 | r, -1)) >= 0:
                add_to(s, h)
                low = low or s < r
            if low and k + 1 < len(spots):  # a lower rank came up: it goes first
                add_to(r, np.array(spots[k + 1:]))
                return

    def encode(self, texts: list[str | None]) -> Iterator[list[int]]:
        """Ids of every text of a block."""
        parts = [self.split(t) if t else [] for t in texts]
        table = self.pieces
        new: dict[str, None] = {}
        for words in parts:
            for w in words:
                if w not in table:
                    new[w] = None
        if new:
            self.learn_pieces(new)
        for words in parts:
            out: list[int] = []
            for w in words:
                out += table[w]
            yield out
        if len(table) > MAX_PIECES:
            self.pieces = {}

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.vocab.__getitem__, ids))


_ENCODER: dict[int, CorpusBpe] = {}


def encoder_of(bc) -> CorpusBpe:
    """One encoder per worker and rank file."""
    if bc.id not in _ENCODER:
        _ENCODER.clear()
        _ENCODER[bc.id] = CorpusBpe(load_ranks(bc.value))
    return _ENCODER[bc.id]


class _Ranks:
    """The rank file's bytes with a name that workers can key on."""

    def __init__(self, value: bytes):
        self.value, self.id = value, hash(value)


def _rank_bytes(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def map_tokens(docs: DataFrame, row: Callable[[CorpusBpe, list[int]], tuple], fields: list[tuple[str, pa.DataType, str]],
               id_col: str | Column = "doc_id", text_col: str | Column = "text",
               ranks_path: str = DEFAULT_RANKS) -> DataFrame:
    """(doc_id, *fields): ``row(encoder, ids)`` gives the fields of a document."""
    ship_package(docs.sparkSession)
    bc = docs.sparkSession.sparkContext.broadcast(_rank_bytes(ranks_path))  # under 1 MB
    schema = pa.schema([(n, t) for n, t, _ in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = None
        for b in batches:
            enc = enc or encoder_of(_Ranks(bc.value))
            for at in range(0, b.num_rows, BLOCK_ROWS):
                part = b.slice(at, BLOCK_ROWS)
                rows = [row(enc, ids) for ids in enc.encode(part.column(1).to_pylist())]
                cols = [pa.array(c, t) for c, t in zip(zip(*rows), schema.types)]
                yield pa.RecordBatch.from_arrays([part.column(0), *cols], ["doc_id", *schema.names])

    frame = docs.select(F.col(id_col).alias("doc_id") if isinstance(id_col, str) else id_col.alias("doc_id"),
                        (F.col(text_col) if isinstance(text_col, str) else text_col).cast("string").alias("text"))
    id_type = frame.schema["doc_id"].dataType.simpleString()
    return frame.mapInArrow(run, ", ".join([f"doc_id {id_type}", *(f"{n} {s}" for n, _, s in fields)]))


def encode(docs: DataFrame, **kw) -> DataFrame:
    """(doc_id, ids array<int>) of every text."""
    return map_tokens(docs, lambda e, ids: (ids,), [("ids", pa.list_(pa.int32()), "array<int>")], **kw)


def decode(tokens: DataFrame, ranks_path: str = DEFAULT_RANKS) -> DataFrame:
    """(doc_id, bytes binary) of a frame made by :func:`encode`; null ids decode to nothing."""
    bc = tokens.sparkSession.sparkContext.broadcast(_rank_bytes(ranks_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = None
        for b in batches:
            enc = enc or encoder_of(_Ranks(bc.value))
            out = [enc.decode(ids or ()) for ids in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], ["doc_id", "bytes"])

    frame = tokens.select("doc_id", "ids")
    return frame.mapInArrow(run, f"doc_id {frame.schema['doc_id'].dataType.simpleString()}, bytes binary")
