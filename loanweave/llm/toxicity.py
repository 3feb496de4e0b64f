"""Toxicity by a weighted finite-state pattern grammar.

Words of a clause become symbols: learned insult stems, threat verbs, targets
(you, they, ...), negations, reporting verbs, anything else.  Four small
transducers read the clause one after another -- reported speech, negation,
target, and a weigher -- and are composed once into a single machine whose
arcs carry log-odds; a clause weighs the sum along its path, so "you are an
idiot" outweighs "idiot", and "he said that nobody is an idiot" weighs less.

A document's log-odds are the prior, plus the weights of its matched clauses,
minus the matches that a toxic text of its length would be expected to have.  A
single chance match in a long text therefore counts against it, and a stem that
clean texts use now and then condemns only where it piles up.

Insult stems (word beginnings of 4 to 6 letters), their log-odds, the prior and
the expected rate are learned from a bounded sample of labelled documents; the
grammar's own weights are fixed values below.  Scoring is one pass without a
shuffle: an Aho-Corasick automaton finds the words that can weigh, and only
their clauses are parsed.

While learning, a text counts ``MOST_PER_TEXT`` times at most for a stem.

Defined results: a null or empty text scores the prior; labels on repeated
doc_ids each count; null labels are not read; without labelled rows of both
kinds all texts score 0 (1 if all are toxic).  Repeated documents give repeated
results; very long texts and clauses are read whole; an empty table gives no
rows; equal stems cannot tie, each has one weight; other columns of the input
are not read, and :func:`keep_civil` hands them on.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanweave.llm.common import drop_staged, mix64, ship_package, stage
from loanweave.llm.langid import held_out
from loanweave.llm.minhash import shingle_sets

#: Labelled documents to learn from, at most (in expectation).
MAX_LABELLED = 12_000
STEM_LENGTHS = (4, 5, 6)
MIN_TOXIC_DOCS = 4
MIN_STEM_ODDS = 1.8  # log of the ratio of a stem's rates in toxic and clean texts
MIN_DOC_ODDS = 1.2  # the same for the shares of texts that have the stem
MIN_EVIDENCE = 15.0  # toxic texts with the stem times its log-odds
MOST_PER_TEXT = 6  # times that one text counts for a stem
THRESHOLD = 0.3

# Word classes of the grammar, in English, German, French and Spanish.
THREATS = ("kill", "murder", "hurt", "destroy", "shoot", "stab", "töten", "umbringen", "verletzen", "vernichten",
           "tuer", "frapper", "détruire", "matar", "herir", "destruir")
TARGETS = ("you", "your", "he", "him", "she", "her", "they", "them", "people", "du", "dich", "dir", "ihr", "euch", "sie",
           "tu", "toi", "te", "vous", "ils", "elles", "usted", "ustedes", "ellos", "ellas", "ti")
NEGATIONS = ("not", "no", "never", "nobody", "isn't", "aren't", "nicht", "kein", "keine", "nie", "niemand", "ne", "pas",
             "jamais", "nunca", "nadie", "ningún")
REPORTS = ("said", "says", "called", "wrote", "quoted", "sagte", "sagt", "nannte", "schrieb", "dit", "disait", "écrit",
           "dijo", "dice", "llamó", "escribió")
# Log-odds that context adds to a match.
TARGETED, NEGATED, REPORTED = 0.7, -1.5, -1.0
THREAT, UNTARGETED_THREAT = 5.0, 0.0
NEGATION_REACH = 3  # words after a negation that it covers

_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
_CLAUSE_END = re.compile(r"[.,;:!?\n]")


class Transducer:
    """Deterministic weighted transducer: ``step(state, symbol) -> (state, output, weight)``.
    A symbol is (kind, flags); start state 0."""

    def __init__(self, step):
        self.step = step

    def __rshift__(self, other: Transducer) -> Transducer:
        """Composition: this one's output is the other's input; weights add up."""
        def step(state, symbol):
            a, b = state or (0, 0)
            a, middle, w = self.step(a, symbol)
            b, out, v = other.step(b, middle)
            return (a, b), out, w + v
        return Transducer(step)

    def compiled(self, kinds: tuple[str, ...]) -> dict:
        """All reachable arcs as a table."""
        table, todo = {}, [0]
        while todo:
            state = todo.pop()
            for kind in kinds:
                if (state, kind) not in table:
                    arc = self.step(state, (kind, frozenset()))
                    table[state, kind] = arc
                    todo.append(arc[0])
        return table


KINDS = ("insult", "threat", "target", "negation", "report", "other")
_WEIGHS = ("insult", "threat")


def _flag(symbol, name: str, on: bool):
    kind, flags = symbol
    return (kind, flags | {name}) if on and kind in _WEIGHS else symbol


REPORTED_SPEECH = Transducer(lambda s, x: (1 if x[0] == "report" else s, _flag(x, "reported", bool(s)), 0.0))
NEGATION = Transducer(lambda s, x: (NEGATION_REACH if x[0] == "negation" else max(0, s - 1), _flag(x, "negated", s > 0), 0.0))
TARGET = Transducer(lambda s, x: (1 if x[0] == "target" else s, _flag(x, "targeted", bool(s)), 0.0))


def _weigh(state, symbol):
    kind, flags = symbol
    if kind not in _WEIGHS:
        return 0, symbol, 0.0
    w = (THREAT if "targeted" in flags else UNTARGETED_THREAT) if kind == "threat" else \
        TARGETED * ("targeted" in flags)
    return 0, symbol, w + NEGATED * ("negated" in flags) + REPORTED * ("reported" in flags)


GRAMMAR = REPORTED_SPEECH >> NEGATION >> TARGET >> Transducer(_weigh)


class Model:
    """What is learned: stem -> log-odds, the prior's log-odds, and by how much more often
    toxic texts have a match, per word."""

    def __init__(self, stems: dict[str, float], prior: float, rate: float):
        self.stems, self.prior, self.rate = stems, prior, rate

    @property
    def key(self) -> tuple:
        return tuple(sorted(self.stems.items())), self.prior, self.rate


class ClauseScorer:
    """The composed machine over one model."""

    def __init__(self, model: Model):
        self.model, self.stems = model, model.stems
        self.arcs = GRAMMAR.compiled(KINDS)
        self.fixed = {w: k for k, words in (("target", TARGETS), ("negation", NEGATIONS), ("report", REPORTS),
                                            ("threat", THREATS)) for w in words}
        self.finder = ahocorasick.Automaton()
        for w in (*model.stems, *THREATS):
            self.finder.add_word(w, len(w))
        self.finder.make_automaton()

    def classify(self, word: str) -> tuple[str, float]:
        kind = self.fixed.get(word)
        if kind:
            return kind, 0.0
        for n in STEM_LENGTHS:
            w = self.stems.get(word[:n])
            if w is not None and len(word) >= n:
                return "insult", w
        return "other", 0.0

    def clause_weight(self, clause: str) -> float | None:
        """Log-odds along the clause's path; None if no insult or threat is on it.  A target
        that comes after the match counts too: a clause with a target anywhere is read
        with one known from the start."""
        words = [self.classify(w) for w in _WORD.findall(clause)]
        if any(k == "target" for k, _ in words):
            words = [("target", 0.0), *words]
        total, found, state = 0.0, False, 0
        for kind, own in words:
            state, _, w = self.arcs[state, kind]
            if kind in _WEIGHS:
                total, found = total + w + own, True
        return total if found else None

    def clauses(self, text: str) -> Iterator[float]:
        """Weights of the clauses that hold a match, each read whole, from punctuation to
        punctuation, and once, however long it is and however many matches it has."""
        low = text.lower()
        ends: list[int] | None = None
        done = 0  # where the last clause that was read ends
        for last, n in self.finder.iter(low):
            first = last - n + 1
            if first < done or (first and low[first - 1].isalpha()):
                continue
            if ends is None:
                ends = [m.start() for m in _CLAUSE_END.finditer(low)]
            k = bisect_left(ends, first)
            begin = ends[k - 1] + 1 if k else 0
            done = ends[k] if k < len(ends) else len(low)
            w = self.clause_weight(low[begin:done])
            if w is not None:
                yield w

    def score(self, text: str | None) -> float:
        odds = self.model.prior
        if text:
            words = 1 + text.count(" ") + text.count("\n")
            odds += sum(self.clauses(text)) - self.model.rate * words
        return 1.0 / (1.0 + math.exp(-max(-700.0, min(700.0, odds))))


def _stems_of(text: str) -> tuple[Counter, int]:
    words = [m.split("'")[0] for m in _WORD.findall(text.lower())]
    return Counter(w[:n] for w in words for n in STEM_LENGTHS if len(w) >= n), len(words)


def _single_copies(sample: DataFrame) -> DataFrame:
    """Copies of a text count once, or its chance words would look like insults: of rows that
    agree in a minimum of their hashed 4-word shingles one is kept, for two such minima in turn."""
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = shingle_sets(b.column(1), 4)
            k1 = [int(s.min() >> np.uint64(1)) if len(s) else 0 for s in sets]
            k2 = [int(mix64(s).min() >> np.uint64(1)) if len(s) else 0 for s in sets]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(k1, pa.int64()), pa.array(k2, pa.int64())],
                                             ["y", "text", "k1", "k2"])
    keyed = sample.mapInArrow(keys, "y int, text string, k1 bigint, k2 bigint")
    once = keyed.groupBy("k1").agg(F.min(F.struct("k2", "y", "text")).alias("x")).select("x.*")
    return once.groupBy("k2").agg(F.min(F.struct("y", "text")).alias("x")).select("x.*")


def learn(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Model:
    """The model from a sample of the labelled rows: those whose hashed doc_id falls under a
    threshold, so only that share of the documents' texts is shuffled, whatever the table's
    size.  Tasks count their stems before the shuffle; what reaches the driver are the
    stems that pass the tests below."""
    ship_package(docs.sparkSession)
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select(
        "doc_id", (F.col("toxic") > 0).cast("int").alias("y"))
    n = known.count()
    if not n:
        return Model({}, -math.inf, 0.0)
    share = min(1.0, max_labelled / n)
    drawn = (F.xxhash64(F.col("doc_id").cast("string"), F.lit("tox")) / 2.0**64 + 0.5) < share
    sample = _single_copies(docs.where(drawn & F.col("text").isNotNull()).select("doc_id", F.col("text").cast("string").alias("text"))
                            .join(known.where(drawn), "doc_id").select("y", "text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = (Counter(), Counter())
        texts = (Counter(), Counter())
        size = [0, 0]
        rows = [0, 0]
        for b in batches:
            for y, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found, n_words = _stems_of(text)
                tokens[y].update({s: min(c, MOST_PER_TEXT) for s, c in found.items()})
                texts[y].update(found.keys())
                size[y] += n_words
                rows[y] += 1
        stems = sorted({*tokens[0], *tokens[1]})
        yield pa.RecordBatch.from_arrays(
            [pa.array(["", *stems], pa.string()), pa.array([size[1], *(tokens[1][s] for s in stems)], pa.int64()),
             pa.array([size[0], *(tokens[0][s] for s in stems)], pa.int64()),
             pa.array([rows[1], *(texts[1][s] for s in stems)], pa.int64()),
             pa.array([rows[0], *(texts[0][s] for s in stems)], pa.int64())],
            ["stem", "pos", "neg", "docs", "clean_docs"])

    counts = stage(sample.mapInArrow(count, "stem string, pos bigint, neg bigint, docs bigint, clean_docs bigint").groupBy("stem").agg(
        *[F.sum(c).alias(c) for c in ("pos", "neg", "docs", "clean_docs")]), "toxic_stems")
    total = counts.where("stem = ''").first()
    if total is None or not total.docs or not total.clean_docs:
        return Model({}, math.inf if total is not None and total.docs else -math.inf, 0.0)
    odds = F.log((F.col("pos") + 0.5) / (total.pos + 1.0)) - F.log((F.col("neg") + 0.5) / (total.neg + 1.0))
    share = F.log((F.col("docs") + 0.5) / (total.docs + 1.0)) - F.log((F.col("clean_docs") + 0.5) / (total.clean_docs + 1.0))
    # From counts over a bounded sample, so bounded itself.
    found = counts.where((F.col("stem") != "") & (F.col("docs") >= MIN_TOXIC_DOCS) & (share >= MIN_DOC_ODDS)
                         & (odds * F.col("docs") >= MIN_EVIDENCE)).select("stem", "pos", "neg", odds.alias("odds")).where(
        F.col("odds") >= MIN_STEM_ODDS).collect()
    drop_staged(counts)
    stems, pos, neg = {}, 0, 0
    for r in sorted(found, key=lambda r: (len(r.stem), r.stem)):
        if not any(r.stem[:k] in stems for k in STEM_LENGTHS):
            stems[r.stem] = r.odds
            pos, neg = pos + r.pos, neg + r.neg
    rate = max(0.0, pos / max(1, total.pos) - neg / max(1, total.neg))
    return Model(stems, math.log(total.docs / total.clean_docs), rate)


_SCORER: dict = {}


def _scorer(model: Model) -> ClauseScorer:
    if model.key not in _SCORER:
        _SCORER.clear()
        _SCORER[model.key] = ClauseScorer(model)
    return _SCORER[model.key]


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every text."""
    ship_package(docs.sparkSession)
    frame = docs.select("doc_id", F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            machine = _scorer(model)
            texts = b.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([machine.score(t) for t in texts], pa.float64())], ["doc_id", "score"])

    return frame.mapInArrow(run, f"doc_id {frame.schema['doc_id'].dataType.simpleString()}, score double")


def keep_civil(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` (all columns) that score under ``threshold``."""
    ship_package(docs.sparkSession)
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            machine = _scorer(model)
            texts = b.column(place).cast(pa.string()).to_pylist()
            yield b.filter(pa.array(np.array([machine.score(t) < threshold for t in texts], bool)))

    return docs.mapInArrow(run, docs.schema)
