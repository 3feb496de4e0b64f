"""Personal data by candidate gradient boosting, in DataFrame functions only.

Exact rules give the base spans (e-mail, IPv4, card, phone), which always stay.
Beside them loose generators propose overlapping spans; a boosted-tree model
scores each from its format and context, and thresholds calibrated per kind
select the spans that are added.  The trees are fitted by Spark ML on the
candidates that could be added in all documents, equal ones counted once: those beside
all base spans of their kind count as false; the true ones come from a second
copy of each text, whose base spans are rewritten in loose forms where they
stand.  So loose forms are taken to be about as frequent as exact ones.  The
trees are then written out as a column expression: a document's candidates are
scored inside its own row, without a join or a shuffle.

Regular expressions are possessive, so they neither recurse nor backtrack on
very long texts; documents without a digit or an ``@`` are not searched.

Defined results: a null or empty text has no spans and stays as it is;
positions are code points, ends exclusive; spans are ordered by start, then
kind as in ``KINDS``; repeated rows give repeated results; of a kind without a
true candidate nothing is added, of one without a false candidate
every candidate is; an empty table gives no rows; very long texts are searched
whole; overlapping candidates of one kind each stand for themselves.  The other columns of
the input stay, but for those that have the names of the two results.
"""

from __future__ import annotations

import re
import uuid
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanweave.llm.common import stage

KINDS = ("email", "ip", "card", "phone")
#: Share of the documents, by their hashed text, whose candidates the trees are fitted on; those of the others calibrate.
FIT_SHARE = 2 / 3
#: Share of weakly labelled candidates above a threshold that must be true.
MIN_PRECISION = 0.99
CONTEXT = 24
#: Of the boosted trees of a kind: the first counts in full, the others by the step size.
TREE_WEIGHTS = (1.0,) + (0.4,) * 7

_LOCAL = "A-Za-z0-9._%+-"
# The base rules; \G lets a match begin where the last one ended inside a run.
BASE = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Loose forms: spaced or spelt-out signs, other separators, missing prefixes.
LOOSE = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]++"
             r"(?:(?:\.|\x20\.\x20|\x20?(?:\(dot\)|\[dot\])\x20?)[A-Za-z0-9-]++)*+",
    "ip": r"(?<![0-9])[0-9]{1,3}+(?:\x20?[.,-]\x20?[0-9]{1,3}+){3}",
    "card": r"(?<![0-9])[0-9](?:[\x20.-]{0,2}+[0-9]){11,18}+",
    "phone": r"(?:\+|\()?(?<![0-9])[0-9](?:[\x20().-]{0,3}+[0-9]){6,14}+",
}
FEATURES = ("kind", "digits", "letters", "separators", "groups", "plus", "at", "luhn", "octets", "before", "after", "keyword", "dots")
KEYWORDS = (r"(?i)(mail|contact|tel|phone|call|fon|card|visa|credit|konto|carte|tarjeta|\bip\b|host|addr)")


def _found(text: Column, pattern: str) -> Column:
    """Matches as (m, s, e): text, start and end.  The pieces between matches give the places."""
    hits, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    kind = "array<struct<m:string,s:int,e:int>>"

    def add(acc: Column, pair: Column) -> Column:
        start = acc["at"] + F.length(pair["between"])
        end = start + F.length(pair["hits"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(
            pair["hits"].alias("m"), start.alias("s"), end.alias("e")))).alias("out"))

    walked = F.aggregate(F.arrays_zip(hits.alias("hits"), F.slice(between, F.lit(1), F.size(hits)).alias("between")),
                         F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out")), add, lambda acc: acc["out"])
    return F.when(F.size(hits) > 0, walked).otherwise(F.array().cast(kind))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(d: Column) -> Column:
    def step(acc: Column, i: Column) -> Column:
        x = F.substr(d, F.length(d) - i, F.lit(1)).cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return acc + F.when(x > 9, x - 9).otherwise(x)
    total = F.aggregate(F.sequence(F.lit(0), F.length(d) - 1), F.lit(0), step)
    return F.when(F.length(d).between(12, 19), total % 10 == 0).otherwise(False)


def _octets(m: Column, sign: str) -> Column:
    parts = F.split(m, sign, -1)
    return (F.size(parts) == 4) & F.forall(parts, lambda p: (F.length(F.regexp_replace(F.trim(p), "^0+(?=[0-9])", "")) <= 3)
                                           & (F.coalesce(F.trim(p).try_cast("decimal(38,0)"), F.lit(999)) <= 255))


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        stripped = F.transform(F.split(m, r"\.", -1), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(stripped, lambda p: (F.length(p) <= 3) & (F.substring(p, 1, 3).cast("int") <= 255))
    if kind == "card":
        return _luhn(_digits(m))
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    return F.lit(True)


def _search(text: Column, kind: str, pattern: str) -> Column:
    may = F.contains(text, F.lit("@")) | text.rlike(r"[\[(]at[\])]") if kind == "email" else text.rlike("[0-9]")
    return F.when(may, _found(text, pattern)).otherwise(F.array().cast("array<struct<m:string,s:int,e:int>>"))


def _spans(kind: str, found: Column) -> Column:
    return F.transform(found, lambda c: F.struct(c["s"].alias("s"), F.lit(KINDS.index(kind)).alias("k"), c["e"].alias("e")))


def base_spans(text: Column) -> dict[str, Column]:
    """Kind -> array of (s, k, e) that the base rules find."""
    def valid(kind: str):
        return lambda c: _valid(kind, c["m"])
    return {kind: _spans(kind, F.filter(_search(text, kind, BASE[kind]), valid(kind))) for kind in KINDS}


def _char_class(c: Column) -> Column:
    return (F.when(F.length(c) == 0, 0).when(c.rlike(r"\s"), 0).when(c.rlike(r"\p{L}"), 2).when(c.rlike("[0-9]"), 3).otherwise(1))


def candidates(text: Column) -> Column:
    """Every generator's spans as structs of place and features."""
    def describe(kind: str):
        return lambda c: described(kind, c)

    def described(kind: str, c: Column) -> Column:
        m = c["m"]
        lead = F.substr(text, F.greatest(c["s"] + 1 - CONTEXT, F.lit(1)), F.least(c["s"], F.lit(CONTEXT)))
        d = _digits(m)
        values = {
            "kind": F.lit(KINDS.index(kind)), "digits": F.length(d), "letters": F.length(F.regexp_replace(m, "[^A-Za-z]", "")),
            "separators": F.length(F.regexp_replace(m, r"[^ ().-]", "")), "groups": F.size(F.regexp_extract_all(m, F.lit("[0-9]+"), F.lit(0))),
            "plus": F.contains(m, F.lit("+")).cast("int"), "at": F.contains(m, F.lit("@")).cast("int"),
            "luhn": _luhn(d).cast("int") if kind == "card" else F.lit(0),
            "octets": _octets(m, "[.,-]").cast("int") if kind == "ip" else F.lit(0),
            "before": _char_class(F.substr(text, F.greatest(c["s"], F.lit(1)), F.least(c["s"], F.lit(1)))),
            "after": _char_class(F.substr(text, c["e"] + 1, F.lit(1))), "keyword": lead.rlike(KEYWORDS).cast("int"),
            "dots": F.length(F.regexp_replace(m, r"[^.]", "")),
        }
        return F.struct(c["s"].alias("s"), F.lit(KINDS.index(kind)).alias("k"), c["e"].alias("e"),
                        *[values[f].cast("int").alias(f"f_{f}") for f in FEATURES])

    return F.concat(*[F.transform(_search(text, kind, LOOSE[kind]), describe(kind)) for kind in KINDS])


def _overlaps(c: Column, spans: Column) -> Column:
    return F.exists(spans, lambda b: (b["k"] == c["k"]) & (b["s"] < c["e"]) & (c["s"] < b["e"]))


def _loose_forms(kind: str, m: Column) -> list[Column]:
    """Spellings of a base span that its loose generator proposes and no base rule takes."""
    if kind == "email":
        spelt = F.regexp_replace(m, r"\.(?=[^@]*$)", "(dot)")
        return [F.replace(m, F.lit("@"), F.lit(at)) for at in (" (at) ", "(at)", "[at]", " @ ")] + [F.replace(spelt, F.lit("@"), F.lit("(at)"))]
    if kind == "ip":
        return [F.replace(m, F.lit("."), F.lit(sign)) for sign in (",", ", ", " . ", "-")]
    if kind == "card":
        return [F.regexp_replace(_digits(m), "([0-9]{4})(?=[0-9])", f"$1{sign}") for sign in (".", "  ", "--", ". ")]
    bare = F.regexp_replace(m, "[+()]", "")
    return [F.replace(m, F.lit("+"), F.lit(""))] + [F.regexp_replace(bare, "[\\x20.-]+", sign) for sign in (" ", ".", "-")]


def loosened(text: Column, spans: Column) -> Column:
    """``text`` with each of the ordered ``spans`` in one of its loose forms, and the places (s, k, e) of these."""
    kind = "array<struct<s:int,k:int,e:int>>"

    def form(c: Column) -> Column:
        m = F.substr(text, c["s"] + 1, c["e"] - c["s"])
        choice = F.when(F.lit(False), m)
        for k, name in enumerate(KINDS):
            forms = _loose_forms(name, m)
            choice = choice.when(c["k"] == k, F.get(F.array(*forms), F.pmod(F.xxhash64(m, c["s"]), F.lit(len(forms))).cast("int")))
        return choice

    def put(acc: Column, c: Column) -> Column:
        out = F.concat(acc["out"], F.substr(text, acc["at"] + 1, c["s"] - acc["at"]))
        new = F.concat(out, form(c))
        place = F.struct(F.length(out).alias("s"), c["k"].alias("k"), F.length(new).alias("e"))
        return F.when(c["s"] >= acc["at"], F.struct(c["e"].alias("at"), new.alias("out"), F.concat(acc["places"], F.array(place)).alias("places"))
                      ).otherwise(acc)

    return F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out"), F.array().cast(kind).alias("places")), put,
                       lambda acc: F.struct(F.concat(acc["out"], F.substr(text, acc["at"] + 1, F.length(text))).alias("text"),
                                            acc["places"].alias("places")))


class Model:
    """Boosted trees as nested (feature, threshold, left, right) tuples, and thresholds per kind."""

    def __init__(self, trees: list[tuple[float, object]], thresholds: dict[int, float]):
        self.trees, self.thresholds = trees, thresholds

    def probability(self, feature) -> Column:
        """``feature(i)``: the column of feature ``i``."""
        def leaf(node) -> Column:
            if not isinstance(node, tuple):
                return F.lit(float(node))
            i, at, low, high = node
            return F.when(feature(i) <= at, leaf(low)).otherwise(leaf(high))
        margin = reduce(lambda a, b: a + b, [w * leaf(t) for w, t in self.trees])
        return 1.0 / (1.0 + F.exp(-2.0 * margin))

    def selects(self, c: Column) -> Column:
        if not self.trees:
            return F.lit(False)
        least = reduce(lambda e, k: e.when(c["k"] == k, self.thresholds[k]), self.thresholds, F.when(F.lit(False), 2.0)).otherwise(2.0)
        return self.probability(lambda i: c[f"f_{FEATURES[i]}"]) >= least


def _parse_trees(said: str) -> list[tuple[float, object]]:
    """The trees of a fitted model from its printed form."""
    lines = [x.strip() for x in said.splitlines()]

    def node(at: int):
        if m := re.match(r"Predict: (\S+)", lines[at]):
            return float(m[1]), at + 1
        m = re.match(r"If \(feature (\d+) <= (\S+)\)", lines[at])
        low, at = node(at + 1)
        high, at = node(at + 1)  # past the Else line
        return (int(m[1]), float(m[2]), low, high), at

    return [(float(m[1]), node(at + 1)[0]) for at, x in enumerate(lines) if (m := re.match(r"Tree \d+ \(weight (\S+)\):", x))]


def fit(docs: DataFrame) -> Model:
    """Fit and calibrate on the candidates of all documents."""
    h = F.pmod(F.xxhash64("text"), F.lit(1 << 20)) / float(1 << 20)
    text = F.col("text")
    sought = docs.select(F.col("text").cast("string").alias("text")).where(text.isNotNull()).select(
        (h < FIT_SHARE).alias("fit"), "text", F.array_sort(F.concat(*base_spans(text).values())).alias("b"))
    false = sought.select("fit", F.explode(F.transform(F.filter(candidates(text), lambda c: ~_overlaps(c, F.col("b"))),
                                                       lambda c: F.struct(c.alias("c"), F.lit(False).alias("y")))).alias("x"))
    loose = sought.where(F.size("b") > 0).select("fit", loosened(text, F.col("b")).alias("l")).select(
        "fit", F.col("l.text").alias("text"), F.col("l.places").alias("b"))
    # Candidates elsewhere in the rewritten copy are those of the text itself.
    there = F.filter(candidates(text), lambda c: F.exists("b", lambda b: (b["s"] < c["e"]) & (c["s"] < b["e"])))
    true = loose.select("fit", F.explode(F.transform(there, lambda c: F.struct(c.alias("c"), F.exists("b", lambda b: (
        b["k"] == c["k"]) & (c["s"] <= b["s"]) & (b["e"] <= c["e"])).alias("y")))).alias("x"))
    marked = false.unionByName(true)
    cols = [f"f_{f}" for f in FEATURES]
    counted = stage(marked.select("fit", F.col("x.y").cast("double").alias("label"), *[F.col(f"x.c.{c}") for c in cols]).groupBy(
        "fit", "label", *cols).agg(F.count("*").cast("double").alias("n")), "pii_counts")
    train = counted.where("fit")
    labels: dict[int, set] = {}
    for r in train.select("f_kind", "label").distinct().collect():
        labels.setdefault(r.f_kind, set()).add(r.label)
    if not any(1.0 in y for y in labels.values()):
        return Model([], {})

    def fitted(k: int) -> list[tuple[float, object]]:
        y = labels.get(k, {0.0})
        if len(y) < 2:
            return [(w, 5.0 if 1.0 in y else -5.0) for w in TREE_WEIGHTS]
        vectors = VectorAssembler(inputCols=cols, outputCol="features").transform(train.where(F.col("f_kind") == k))
        return _parse_trees(GBTClassifier(labelCol="label", weightCol="n", maxIter=len(TREE_WEIGHTS), maxDepth=4, stepSize=TREE_WEIGHTS[1],
                                          seed=7).fit(vectors).toDebugString)

    # Each kind has trees of its own; the n-th ones of all kinds become one tree that first asks for the kind.
    trees = [(w, reduce(lambda rest, kt: (0, kt[0] + 0.5, kt[1], rest), reversed(list(enumerate(nth[:-1]))), nth[-1]))
             for w, nth in zip(TREE_WEIGHTS, zip(*[[t for _, t in fitted(k)] for k in range(len(KINDS))]))]
    p = F.round(Model(trees, {}).probability(lambda i: F.col(cols[i])), 9)
    # One row per kind and distinct score: as many as the trees have combinations of leaves.
    seen = counted.where("not fit").select(F.col("f_kind").alias("k"), p.alias("p"), "label", "n").groupBy("k", "p").agg(
        F.sum(F.col("n") * F.col("label")).alias("pos"), F.sum("n").alias("n")).collect()
    thresholds = {}
    for k in range(len(KINDS)):
        pos = total = 0.0
        for r in sorted((r for r in seen if r.k == k), key=lambda r: -r.p):
            pos, total = pos + r.pos, total + r.n
            if pos < MIN_PRECISION * total:
                break
            thresholds[k] = r.p - 1e-9
    return Model(trees, thresholds)


def find(docs: DataFrame, model: Model, base_name: str = "pii_base", spans_name: str = "pii_spans") -> DataFrame:
    """All columns of ``docs`` plus the base and all spans as arrays of (s, k, e); columns that
    have these names already are replaced."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = F.array_sort(F.concat(*base_spans(text).values()))
    out = docs.withColumn(base_name, base)
    if not model.trees:
        return out.withColumn(spans_name, F.col(base_name))
    extra = F.filter(candidates(text), lambda c: model.selects(c) & ~_overlaps(c, F.col(base_name)))
    added = F.transform(extra, lambda c: F.struct(c["s"].alias("s"), c["k"].alias("k"), c["e"].alias("e")))
    return out.withColumn(spans_name, F.array_sort(F.concat(base_name, added)))


def said(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda c: F.concat_ws(":", F.get(names, c["k"]), c["s"].cast("string"), c["e"].cast("string"))), ",")


def redact(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets (overlapping spans by the
    first one's), and ``n_chars`` brought up to date."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    own = uuid.uuid4().hex  # no column of the input has these names
    base_name, spans_name = f"base_{own}", f"spans_{own}"

    def cut(acc: Column, c: Column) -> Column:
        more = F.concat(acc["out"], F.substr(F.col("text"), acc["at"] + 1, c["s"] - acc["at"]), F.get(names, c["k"]))
        return F.struct(F.greatest(acc["at"], c["e"]).alias("at"), F.when(c["s"] >= acc["at"], more).otherwise(acc["out"]).alias("out"))

    done = F.aggregate(spans_name, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), cut,
                       lambda acc: F.concat(acc["out"], F.substr(F.col("text"), acc["at"] + 1, F.length("text"))))
    out = find(docs, model, base_name, spans_name).withColumn("text", F.when(F.size(spans_name) > 0, done).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size(spans_name) > 0, F.length("text")).otherwise(F.col("n_chars"))
                             .cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
