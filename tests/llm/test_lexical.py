"""Lexical search against a scan of all documents in plain Python."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from loanweave.llm import lexical, queries

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def scan(items, docs, top=10):
    """(item_id, rank, doc_id, score) rows by the contract, nothing skipped."""
    split = [(d, Counter(terms(t)), len(terms(t))) for d, t in docs]
    nd, nt = sum(1 for x in split if x[2]), sum(x[2] for x in split)
    df = Counter(t for _, c, _ in split for t in c)
    pooled = {}
    for item, text in items:
        pooled.setdefault(item, Counter()).update(terms(text))
    out = []
    for item, want in pooled.items():
        found = []
        for d, c, n in split:
            s = sum(q * math.floor(1000 * math.log((2 * nd + 2) / (2 * df[t] + 1)))
                    * ((1000000000 * c[t]) // (1000 * c[t] + 8 * (25 + (75 * n * nd) // nt))) for t, q in want.items() if t in c)
            if s > 0:
                found.append((-s, d is None, d, s))
        out += [(item, k + 1, d, s) for k, (_, _, d, s) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:top])]
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def corpus(rnd, n):
    words = [f"w{int(1 / (rnd.random() + 0.004))}" for _ in range(4000)]
    base = [" ".join(rnd.choices(words, k=rnd.choice([1, 5, 30, 200]))) for _ in range(n)]
    return [(i, base[rnd.randrange(n)] if rnd.random() < 0.3 else t) for i, t in enumerate(base)]


@pytest.mark.parametrize("block_docs,shard_docs,item_pairs", [(2, 7, 40), (4, 50, 1 << 20), (32, 8192, 1 << 20)])
def test_search_equals_scan(spark, block_docs, shard_docs, item_pairs):
    rnd = random.Random(block_docs)
    docs = corpus(rnd, 400)
    items = [(k, " ".join(rnd.choices(docs[rnd.randrange(400)][1].split(), k=12))) for k in range(20)]
    got = lexical.search(spark.createDataFrame(items, "item_id int, text string"),
                         spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
                         block_docs=block_docs, shard_docs=shard_docs, item_pairs=item_pairs)
    assert rows(got) == scan(items, docs)


def test_odd_rows(spark):
    docs = [(5, "same tie"), (3, "same tie"), (None, "same tie"), (3, "same tie"), (9, None), (10, ""), (11, "!? ..\n"),
            (12, "Ünïcode ÄÄ x1 " * 3), (13, "long " * 60000 + "needle"), (14, "ÜNÏCODE"), (15, "a" * 100000), (16, "Straße_a1B2")]
    items = [(1, "tie TIE other"), (None, "needle"), (None, "same"), (2, ""), (3, None), (4, "nowhere"), (5, "x1 ünïcode ÄÄ"),
             (1, "needle"), (6, "a1b2"), (7, "long")]
    frame = spark.createDataFrame([(*d, "clash", 0) for d in docs], "doc_id long, text string, score string, rank int")
    wanted = spark.createDataFrame([(*i, "clash") for i in items], "item_id long, text string, term string")
    got = lexical.search(wanted, frame)
    assert rows(got) == scan(items, docs)
    assert lexical.search(wanted, frame.limit(0)).collect() == []
    assert lexical.search(wanted.limit(0), frame).columns == ["item_id", "rank", "doc_id", "score"]


@pytest.mark.parametrize("partners", [256, 2])
def test_blocks_are_skipped_and_bounds_hold(monkeypatch, partners):
    monkeypatch.setattr(lexical, "PARTNERS", partners)
    rnd = np.random.default_rng(11)
    n, v = 3000, 40
    topic = rnd.integers(0, 8, n)
    held = rnd.random((n, v)) < np.where(np.arange(v)[None, :] // 5 == topic[:, None], 0.8, 0.05)
    held[:, 0] = True
    impact = np.where(held, rnd.integers(1, 1000, (n, v)), 0)
    doc, term = np.nonzero(held)
    ptr = np.concatenate(([0], np.cumsum(held.sum(1))))
    order = np.arange(v)[::-1].copy()  # term v - 1 is the heaviest
    q_terms = np.arange(v - 1, 34, -1)
    shard = lexical.Shard(np.arange(n), ptr, term, impact[doc, term], order, lexical._partners([(q_terms, None)], order), 16)
    for t in q_terms:
        docs, bounds, summary = shard.blocks(int(t))
        assert sorted(docs) == list(np.flatnonzero(held[:, t]))
        for k in range(len(bounds) - 1):
            assert (summary[k] == impact[docs[bounds[k]:bounds[k + 1]]][:, shard.partners[int(t)]].max(axis=0)).all()
    q = np.ones(len(q_terms), np.int64)
    got = shard.search(q_terms, q, (np.empty(0, np.int64), np.empty(0, np.int64)), 10, np.zeros(v, np.int64), np.zeros(n, bool))
    score = impact[:, q_terms].sum(axis=1)
    want = np.lexsort((np.arange(n), -score))[:10]
    assert list(got[1]) == list(want) and list(got[0]) == list(score[want])
    assert partners == 2 or shard.blocks_opened < 0.7 * shard.blocks_read
