"""Language identification by cross-parsing entropy.

For each language a suffix automaton holds a bounded excerpt of labelled text.
A document is parsed against every automaton: the longest match from where the
last phrase ended is the next phrase.  Text of the same language falls into
few, long phrases; the language with the fewest phrases per symbol wins.

The automata are transition tables, dense for the commonest letters and sorted
arrays of edges for all others, so every letter of the excerpts counts, however
many there are.  A task walks all documents of a batch through all languages at
once, one symbol of every lane per step.  A long text is cut into lanes of
``LANE`` symbols that are parsed side by side; each then reads on beyond its end
until it starts a phrase where the next lane's own parse starts one.  From there on both are
equal, as a phrase depends only on where it starts, so the counts are those of
one parse from the first symbol to the last.  Nothing is shuffled but the
training excerpt: at most ``SAMPLE_DOCS`` documents per language, each with one run of at
most ``SAMPLE_CHARS`` characters that starts at a hashed place in it; each worker receives
and indexes it itself.

Defined results: ``und`` with score 0 for a text that is null, empty or
without letters, and for all texts when nothing was learned; ties go to the
language first in code-point order; repeated rows give repeated results; other
columns of the input are not read.  The score is the relative lead over the
second language, 1 when there is no other.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanweave.llm.common import byte_slices, ship_package

SAMPLE_DOCS = 48
SAMPLE_CHARS = 1000
LANE = 1024
SLICE_BYTES = 1 << 24
DENSE_LETTERS = 120  # letters with a column in the dense table; transitions of the rarer ones are sorted edges

OTHER = 1  # symbol of a letter that no language has; 0 is a gap between words


def held_out(doc_id: Column) -> Column:
    """The rows that nothing is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_text(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS) -> dict[str, str]:
    """Language -> excerpts of the labelled documents first in hash order.  The bound is on rows per
    language and characters per row; where a row's run starts is hashed, so no part of a text is favoured."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))).select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"),
        F.xxhash64(F.col("doc_id").cast("string")).alias("h"))
    places = F.greatest(F.length("text") - sample_chars + 1, F.lit(1))
    rows = rows.select("lang", "h", F.substr("text", (F.pmod("h", places) + 1).cast("int"), F.lit(sample_chars)).alias("part"))
    first = Window.partitionBy("lang").orderBy("h", "part")
    picked = (rows.withColumn("rn", F.row_number().over(first)).where(F.col("rn") <= sample_docs)
              .select("lang", "part", "h").collect())  # bounded by the two parameters
    out: dict[str, list] = {}
    for r in sorted(picked, key=lambda r: (r.lang, r.h, r.part)):
        out.setdefault(r.lang, []).append(r.part)
    return {k: " ".join(v) for k, v in sorted(out.items())}


def _suffix_automaton(symbols: list[int], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Transitions [state, symbol] of symbols under ``width`` and rows (state, symbol, next state)
    of the others; state 1 is the root, 0 stands for none."""
    nexts: list[dict] = [{}, {}]
    link, length = [0, 0], [0, 0]
    last = 1
    for c in symbols:
        cur = len(nexts)
        nexts.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p and c not in nexts[p]:
            nexts[p][c] = cur
            p = link[p]
        if not p:
            link[cur] = 1
        else:
            q = nexts[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nexts)
                nexts.append(dict(nexts[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p and nexts[p].get(c) == q:
                    nexts[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    table = np.zeros((len(nexts), width), np.int32)
    rare = []
    for s, row in enumerate(nexts):
        for c, t in row.items():
            if c < width:
                table[s, c] = t
            else:
                rare.append((s, c, t))
    return table, np.array(rare, np.int64).reshape(-1, 3)


class CrossParser:
    """All languages' automata in one table."""

    def __init__(self, text_of: dict[str, str], lane: int = LANE):
        self.langs = sorted(text_of)
        self.lane = lane
        #: Text that is parsed at once: marks and sums take five bytes a symbol and language.
        self.slice_bytes = SLICE_BYTES // max(1, len(self.langs))
        letters = Counter(c for t in text_of.values() for c in t.lower() if c.isalpha() and len(c) == 1)
        known = [c for c, _ in sorted(letters.items(), key=lambda x: (-x[1], x[0]))]
        self.n_symbols = len(known) + 2
        self.symbol = np.array([chr(i).isalpha() for i in range(0x110000)], np.min_scalar_type(self.n_symbols))  # OTHER for letters
        for k, c in enumerate(known):
            for form in {c, c.upper()}:
                if len(form) == 1:
                    self.symbol[ord(form)] = k + 2
        self.width = min(len(known), DENSE_LETTERS) + 2
        tables, roots, base = [np.zeros((1, self.width), np.int32)], [], 1
        edges = []
        for lang in self.langs:
            s, _ = self._symbols([text_of[lang]])
            t, rare = _suffix_automaton(s.tolist(), self.width)
            t[:, OTHER] = 0
            tables.append(np.where(t[1:] > 0, t[1:] + (base - 1), 0).astype(np.int32))
            roots.append(base)
            edges.append(rare + np.array([base - 1, 0, base - 1]))
            base += len(t) - 1
        self.table = np.concatenate(tables).ravel()
        rare = np.concatenate([np.empty((0, 3), np.int64), *edges])
        keys = rare[:, 0] * self.n_symbols + rare[:, 1]
        order = np.argsort(keys)
        self.rare_keys, self.rare_next = keys[order], rare[order, 2]
        self.roots = np.array(roots, np.int64)[:, None]

    def _symbols(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all texts, one gap between words, and each text's end among them."""
        cp = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass") + b"\n\0\0\0", np.uint32)
        s = self.symbol[cp]
        keep = s > 0
        keep[1:] |= s[:-1] > 0
        ends = np.cumsum([len(t) + 1 for t in texts])
        return s[keep], np.cumsum(keep)[ends - 1]

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(languages x texts) phrase counts, and the number of symbols of each text."""
        s, ends = self._symbols(texts)
        begins = np.concatenate(([0], ends[:-1]))
        sizes = ends - begins
        lanes = -(-sizes // self.lane)
        doc = np.repeat(np.arange(len(texts)), lanes)
        first = np.cumsum(lanes) - lanes
        start = begins[doc] + (np.arange(len(doc)) - first[doc]) * self.lane
        stop = np.minimum(start + self.lane, ends[doc])
        starts = np.zeros((len(self.langs), len(s) + 1), bool)  # where each lane's own parse starts a phrase
        state = np.empty((len(self.langs), len(doc)), np.int64)
        order = np.argsort(start - stop, kind="stable")
        step = 4096 // self.symbol.itemsize  # bounds the symbol matrix of a step to 4 MB
        for at in range(0, len(order), step):
            o = order[at:at + step]
            state[:, o] = self._walk(s, start[o], (stop - start)[o], starts)
        so_far = np.zeros(starts.shape, np.int32)
        np.cumsum(starts[:, :-1], axis=1, out=so_far[:, 1:])
        entry = np.tile(begins, (len(self.langs), 1))
        out = np.zeros(entry.shape, np.int64)
        if len(doc) == (lanes > 0).sum():
            return np.take_along_axis(so_far, np.tile(ends, (len(self.langs), 1)), 1) - np.take_along_axis(so_far, entry, 1), sizes
        beyond, meets = self._read_on(s, starts, state, stop, ends[doc])
        todo_l, todo_d = np.nonzero(np.tile(lanes > 0, (len(self.langs), 1)))
        while len(todo_l):  # a text's lanes one after the other, all texts and languages at once
            e = entry[todo_l, todo_d]
            lane = first[todo_d] + np.minimum((e - begins[todo_d]) // self.lane, lanes[todo_d] - 1)
            out[todo_l, todo_d] += so_far[todo_l, stop[lane]] - so_far[todo_l, e] + beyond[todo_l, lane]
            entry[todo_l, todo_d] = meets[todo_l, lane]
            more = meets[todo_l, lane] < ends[todo_d]
            todo_l, todo_d = todo_l[more], todo_d[more]
        return out, sizes

    def _read_on(self, s, starts, state, stop, end) -> tuple[np.ndarray, np.ndarray]:
        """Per language and lane: phrases it starts beyond its end, and where it meets the next lanes' parse."""
        beyond = np.zeros(state.shape, np.int64)
        meets = np.tile(end, (len(self.langs), 1))
        lang, lane = np.nonzero(np.tile(stop < end, (len(self.langs), 1)))
        at, now = stop[lane].copy(), state[lang, lane]
        while len(lane):
            to, again, root = self._next(now[None, :], s[at].astype(np.int64)[None, :], self.roots[lang, 0][None, :])
            to, again = to[0], again[0]
            fresh = (now == root[0]) | (to == 0)
            met = fresh & starts[lang, at]
            meets[lang[met], lane[met]] = at[met]
            beyond[lang, lane] += fresh & ~met  # each (language, lane) stands here once
            now = np.where(to > 0, to, np.where(again > 0, again, root[0]))
            at += 1
            left = ~met & (at < end[lane])
            lang, lane, at, now = lang[left], lane[left], at[left], now[left]
        return beyond, meets

    def _next(self, state, c, root) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Next states (0 for none) from ``state`` and from the root by symbols ``c``."""
        rare = np.flatnonzero(c[0] >= self.width) if len(self.rare_keys) else ()
        dense = np.where(c < self.width, c, OTHER) if len(rare) else c
        to, again = self.table[state * self.width + dense], self.table[root * self.width + dense]
        if len(rare):
            to[:, rare] = self._rare(state[:, rare], c[:, rare])
            again[:, rare] = self._rare(np.broadcast_to(root, state.shape)[:, rare], c[:, rare])
        return to, again, root

    def _rare(self, state: np.ndarray, c: np.ndarray) -> np.ndarray:
        """Next states (0 for none) by symbols beyond the dense table."""
        key = state * self.n_symbols + c
        at = np.minimum(np.searchsorted(self.rare_keys, key), len(self.rare_keys) - 1)
        return np.where(self.rare_keys[at] == key, self.rare_next[at], 0)

    def _walk(self, s, start, size, starts) -> np.ndarray:
        """Parse lanes (longest first) from the root each; marks where phrases start, returns the states they end in."""
        n, longest = len(size), int(size[0]) if len(size) else 0
        where = np.minimum(start[:, None] + np.arange(longest), len(s) - 1)
        columns = np.ascontiguousarray(s[where].T)
        del where
        active = np.searchsorted(-size, -np.arange(longest), side="left")  # lanes longer than each step
        state = np.repeat(self.roots, n, axis=1)
        for t in range(longest):
            m = active[t]
            to, again, _ = self._next(state[:, :m], columns[t, :m].astype(np.int64)[None, :], self.roots)
            miss = to == 0  # a symbol the language lacks (``again`` 0) is a phrase of its own
            starts[:, start[:m] + t] = miss | (state[:, :m] == self.roots)
            state[:, :m] = np.where(miss, np.where(again == 0, self.roots, again), to)
        return state

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        if not self.langs:
            return ["und"] * len(texts), [0.0] * len(texts)
        counts, sizes = self.phrases([t or "" for t in texts])
        best = counts.argmin(axis=0)
        low = counts[best, np.arange(len(texts))]
        if len(self.langs) > 1:
            second = np.sort(counts, axis=0)[1]
            score = 1.0 - low / np.maximum(second, 1)
        else:
            score = np.ones(len(texts))
        none = sizes == 0
        return ([("und" if z else self.langs[b]) for b, z in zip(best.tolist(), none.tolist())],
                np.where(none, 0.0, score).tolist())


_PARSER: dict = {}


def _parser(text_of: dict[str, str]) -> CrossParser:
    key = hash(tuple(sorted(text_of.items())))
    if key not in _PARSER:
        _PARSER.clear()
        _PARSER[key] = CrossParser(text_of)
    return _PARSER[key]


def predict(docs: DataFrame, text_of: dict[str, str]) -> DataFrame:
    """(doc_id, lang_pred, score) of every text by the given training text."""
    ship_package(docs.sparkSession)
    frame = docs.select("doc_id", F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parser = _parser(text_of)
            for part in byte_slices(b, 1, parser.slice_bytes):
                langs, score = parser.predict(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(langs, pa.string()), pa.array(score, pa.float64())],
                                                 ["doc_id", "lang_pred", "score"])

    return frame.mapInArrow(run, f"doc_id {frame.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")


def keep_identified(docs: DataFrame, text_of: dict[str, str], min_score: float = 0.0) -> DataFrame:
    """The rows of ``docs`` (all columns) whose language is known with at least ``min_score``."""
    ship_package(docs.sparkSession)
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parser = _parser(text_of)
            for part in byte_slices(b, place, parser.slice_bytes):
                langs, score = parser.predict(part.column(place).cast(pa.string()).to_pylist())
                yield part.filter(pa.array([x != "und" and y >= min_score for x, y in zip(langs, score)]))

    return docs.mapInArrow(run, docs.schema)
