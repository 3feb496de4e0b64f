"""Mixture-controlled packing: deficit round-robin over one token queue per source.

Each source's documents form a queue of tokens (ids plus one end id per
document), cut into packets: whole short documents and stretches of ``PACKET``
tokens of longer ones.  In every round a source gains its quantum, ``window *
weight`` tokens, and sends the packets that its deficit covers; what is left is
carried to the next round.  So at the end of every round a backlogged source has
sent at most its target and lacks less than one packet of it.  Rounds follow one another
without a gap and every ``window`` tokens make a sequence, so only the last
sequence has padding; a source that runs dry simply leaves the rotation.

Scale: quanta are fixed-point numbers, so the round that sends a packet follows
from its end in its queue alone, and deficits carry across windows and partitions
without any state being handed on.  One pass encodes and stages the ids once
(16 or 32 bits each); queue positions come from a running sum over (source,
partition) totals.  A round sends about one window of tokens whatever the
sources, so ``CHUNK_ROUNDS`` rounds make a chunk of bounded size: packets are
shuffled to their chunks once, ids included, and take their places by a running sum
there; the chunks' own places are sums of totals in two levels.  Cost is linear in
tokens and does not depend on the number of sources.  Only one total per source,
the mixture table itself, reaches the driver.

Defined results: a null or empty text is a document of the end id alone; a
null source is a queue of its own; repeated rows are packed each; other
columns of the input are not read; an empty table gives no pieces; very long
texts are cut like others.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanweave.llm.common import stage, ship_package

DEFAULT_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
WINDOW = 1024
END_ID = 0
#: Tokens of a packet; a shorter document is one.
PACKET = 256
#: Rounds of a chunk: about this many windows of tokens.
CHUNK_ROUNDS = 2048
#: Fixed-point bits of a quantum.
BITS = 16


def _byte_of_char() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabulary files use for bytes."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class DocTokenizer:
    """Ids as the ``tokenizers`` library gives them for a byte-level BPE file
    (special-token strings in a text become their ids), by the compiled
    encoder of ``tiktoken`` with the same vocabulary."""

    def __init__(self, tokenizer_json: bytes):
        spec = json.loads(tokenizer_json)
        back = _byte_of_char()
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        ranks = {bytes(back[c] for c in tok): i for tok, i in spec["model"]["vocab"].items()
                 if tok not in special}
        self.special = special
        self.enc = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN,
                                     mergeable_ranks=ranks, special_tokens=special)
        self.dtype = np.uint16 if max([*ranks.values(), *special.values()]) < 1 << 16 else np.uint32

    def ids(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, self.dtype)
        return self.enc.encode_to_numpy(text, allowed_special="all").astype(self.dtype)


_TOKENIZER: dict[int, DocTokenizer] = {}


def _tokenizer(data: bytes) -> DocTokenizer:
    key = hash(data)
    if key not in _TOKENIZER:
        _TOKENIZER.clear()
        _TOKENIZER[key] = DocTokenizer(data)
    return _TOKENIZER[key]


def tokenize_queues(docs: DataFrame, tokenizer_path: str = DEFAULT_TOKENIZER,
                    end_id: int = END_ID) -> DataFrame:
    """(doc_id, source, part, before, n, width, ids): the ids of every document
    with the end id, and the tokens of its source before it in its partition."""
    with open(tokenizer_path, "rb") as f:
        bc = docs.sparkSession.sparkContext.broadcast(f.read())  # about 1.5 MB
    id_type = docs.select("doc_id").schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(bc.value)
        part = TaskContext.get().partitionId()
        end = np.array([end_id], tok.dtype)
        sent: dict = {}
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                piece = b.slice(at, 1000)
                before, n, ids = [], [], []
                for text, source in zip(piece.column(2).to_pylist(), piece.column(1).to_pylist()):
                    x = np.concatenate((tok.ids(text), end))
                    before.append(sent.get(source, 0))
                    sent[source] = before[-1] + len(x)
                    n.append(len(x))
                    ids.append(x.tobytes())
                k = piece.num_rows
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), piece.column(1), pa.array([part] * k, pa.int32()),
                     pa.array(before, pa.int64()), pa.array(n, pa.int64()),
                     pa.array([tok.dtype().itemsize] * k, pa.int32()), pa.array(ids, pa.binary())],
                    ["doc_id", "source", "part", "before", "n", "width", "ids"])

    frame = docs.select("doc_id", F.col("source").cast("string").alias("source"),
                        F.col("text").cast("string").alias("text"))
    return frame.mapInArrow(run, f"doc_id {id_type}, source string, part int, before bigint, "
                                 "n bigint, width int, ids binary")


class Mixture:
    """Where the tokens of each queue stand in the packed stream."""

    def __init__(self, totals: dict, weights: dict | None, window: int):
        names = sorted(totals, key=lambda s: (s is not None, s or ""))
        self.row = {s: k for k, s in enumerate(names)}
        self.total = np.array([totals[s] for s in names], np.int64)
        want = [float(weights.get(s, 0.0)) if weights else float(totals[s]) for s in names]
        if weights and (least := min((w for w in want if w > 0), default=1.0)):
            want = [w if w > 0 else least for w in want]  # unlisted: as the smallest listed
        scale = sum(want) or 1.0
        self.quantum = np.array([max(1, round(window * w / scale * (1 << BITS))) for w in want], np.int64)

    def round_of(self, queue: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The round whose deficit first covers a queue's tokens up to ``end``."""
        return -((-end << BITS) // self.quantum[queue])


def runs(mix: Mixture, queue: np.ndarray, first: np.ndarray, n: np.ndarray, packet: int) -> tuple:
    """(document, start, length, round) of the packets of documents with ``n`` tokens from queue
    position ``first`` on; packets of a document that one round sends are one run."""
    packets = -(-n // packet)
    doc = np.repeat(np.arange(len(n)), packets)
    start = (np.arange(len(doc)) - np.repeat(np.cumsum(packets) - packets, packets)) * packet
    end = np.minimum(start + packet, n[doc])
    turn = mix.round_of(queue[doc], first[doc] + end)
    new = np.flatnonzero(np.concatenate(([True], (turn[1:] != turn[:-1]) | (doc[1:] != doc[:-1]))))
    last = np.append(new[1:], len(doc)) - 1
    return doc[new], start[new], end[last] - start[new], turn[new]


def pack(docs: DataFrame, window: int = WINDOW, weights: dict[str, float] | None = None,
         tokenizer_path: str = DEFAULT_TOKENIZER, end_id: int = END_ID,
         with_ids: bool = True, packet: int = PACKET) -> DataFrame:
    """Pieces of all documents: (doc_id, start, length, doc_tokens,
    sequence_id, offset, ids_crc32[, ids]).

    ``weights``: target share per source; by default each source's share of
    all tokens, so that all queues end together.  ``packet``: most tokens that stay
    together; smaller ones hold the shares more tightly, in more pieces.
    ``ids_crc32`` is over little-endian 32-bit ids; ``ids`` are those of the piece.
    """
    ship_package(docs.sparkSession)
    id_type = docs.select("doc_id").schema[0].dataType.simpleString()
    queues = stage(tokenize_queues(docs, tokenizer_path, end_id), "queues")
    parts = queues.groupBy("source", "part").agg(F.sum("n").alias("tokens"))
    run = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = stage(parts.select(F.col("source").alias("q_source"), F.col("part").alias("q_part"), "tokens",
                              F.coalesce(F.sum("tokens").over(run), F.lit(0)).alias("base")), "queue_base")
    # One row per source: the mixture table.
    totals = {r["q_source"]: r["t"] for r in base.groupBy("q_source").agg(F.sum("tokens").alias("t")).collect()}
    if not totals:
        return docs.sparkSession.createDataFrame([], _schema(id_type, with_ids))
    mix = Mixture(totals, weights, window)

    def placed(*more: str) -> DataFrame:
        j = queues.join(base, F.col("source").eqNullSafe(F.col("q_source")) & (F.col("part") == F.col("q_part")))
        return j.select("source", (F.col("base") + F.col("before")).alias("first"), "n", *more)

    def cut_runs(b: pa.RecordBatch) -> tuple:
        queue = np.array([mix.row[x] for x in b.column(0).to_pylist()], np.int64)
        first = b.column(1).to_numpy()
        return queue, first, *runs(mix, queue, first, b.column(2).to_numpy(), packet)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                _, _, _, _, length, turn = cut_runs(b)
                chunk, which = np.unique(turn // CHUNK_ROUNDS, return_inverse=True)
                yield pa.RecordBatch.from_arrays([pa.array(chunk), pa.array(np.bincount(which, weights=length).astype(np.int64))], ["chunk", "tokens"])

    per_chunk = placed().mapInArrow(count, "chunk bigint, tokens bigint").groupBy("chunk").agg(F.sum("tokens").alias("tokens"))
    per_chunk = stage(per_chunk.withColumn("high", F.floor(F.col("chunk") / CHUNK_ROUNDS)), "queue_chunks")
    earlier = Window.orderBy("h").rowsBetween(Window.unboundedPreceding, -1)  # one row per CHUNK_ROUNDS chunks
    high = per_chunk.groupBy(F.col("high").alias("h")).agg(F.sum("tokens").alias("t")).select(
        "h", F.coalesce(F.sum("t").over(earlier), F.lit(0)).alias("high_base"))
    inside = Window.partitionBy("high").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunk_base = stage(per_chunk.withColumn("own", F.coalesce(F.sum("tokens").over(inside), F.lit(0))).join(
        high, F.col("high") == F.col("h")).select(F.col("chunk").alias("c"), (F.col("high_base") + F.col("own")).alias("c_base")), "queue_chunk_base")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                queue, first, doc, start, length, turn = cut_runs(part)
                width = part.column(4).to_numpy()[doc]
                raw = part.column(5).to_pylist()
                ids = [raw[d][s:e] for d, s, e in zip(doc.tolist(), (start * width).tolist(), ((start + length) * width).tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(turn // CHUNK_ROUNDS), pa.array(turn), pa.array(queue[doc]), pa.array(first[doc] + start),
                     part.column(3).take(pa.array(doc)), pa.array(start), pa.array(length), part.column(2).take(pa.array(doc)),
                     pa.array(width.astype(np.int32)), pa.array(ids, pa.binary())],
                    ["chunk", "round", "queue", "position", "doc_id", "start", "length", "doc_tokens", "width", "ids"])

    sent = placed("doc_id", "width", "ids").mapInArrow(send, (
        f"chunk bigint, round bigint, queue bigint, position bigint, doc_id {id_type}, start bigint, length bigint, "
        "doc_tokens bigint, width int, ids binary"))
    line = Window.partitionBy("chunk").orderBy("round", "queue", "position").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ordered = sent.withColumn("upto", F.sum("length").over(line)).join(chunk_base, F.col("chunk") == F.col("c"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 4000):
                part = b.slice(at, 4000)
                place, length, start = (part.column(i).to_numpy() for i in (2, 3, 1))
                pieces = (place + length - 1) // window - place // window + 1  # a run is cut where a window ends
                which = np.repeat(np.arange(len(place)), pieces)
                step = np.arange(len(which)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                lo = np.maximum(place[which], (place[which] // window + step) * window)
                hi = np.minimum(place[which] + length[which], (place[which] // window + step + 1) * window)
                begin = lo - place[which]
                raw, width = part.column(6).to_pylist(), part.column(5).to_pylist()
                crc, ids = [], []
                for k, s, z in zip(which.tolist(), begin.tolist(), (hi - lo).tolist()):
                    tokens = np.frombuffer(raw[k], f"<u{width[k]}", z, s * width[k]).astype("<u4")
                    crc.append(zlib.crc32(tokens))
                    if with_ids:
                        ids.append(tokens.astype(np.int32))
                cols = [part.column(0).take(pa.array(which)), pa.array(start[which] + begin), pa.array(hi - lo),
                        part.column(4).take(pa.array(which)), pa.array(lo // window), pa.array(lo % window), pa.array(crc, pa.int64())]
                if with_ids:
                    cols.append(pa.array(ids, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(cols, _names(with_ids))

    frame = ordered.select("doc_id", "start", (F.col("c_base") + F.col("upto") - F.col("length")).alias("place"), "length", "doc_tokens", "width", "ids")
    return frame.mapInArrow(cut, _schema(id_type, with_ids))


def _names(with_ids: bool) -> list[str]:
    return ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids_crc32"] + ["ids"] * with_ids


def _schema(id_type: str, with_ids: bool) -> str:
    return (f"doc_id {id_type}, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, "
            "offset bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids)
