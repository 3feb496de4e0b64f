"""BPE and packing against the tokenizer libraries and brute force."""

import collections
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from loanweave.llm import bpe, packing, queries

SF = "/root/testdata/sf0.001"
HARD = ["", "a", "aaaa" * 300, " " * 500 + "x", "it's We'LL  \n\n\t end ", "漢字 \U0001F600 naïve ½²Ⅷ __--!?",
        "\x1c\x1d\x85 　​", "x" * 3000 + "\n" + "12 345,6", "<|endoftext|> tail"]


@pytest.fixture(scope="module")
def ranks():
    with open(bpe.DEFAULT_RANKS, "rb") as f:
        return bpe.load_ranks(f.read())


def test_replay_equals_library(ranks):
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rnd = random.Random(3)
    letters = "aAbcé'st  \n\t\x1c\x8512½_-!漢\U0001F600ll're"
    texts = HARD + ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 80))) for _ in range(1500)]
    mine = bpe.CorpusBpe(ranks)
    got = list(mine.encode(texts))
    assert got == [enc.encode_ordinary(t) for t in texts]
    assert [mine.decode(g).decode() for g in got] == texts


def test_replay_puts_a_lower_rank_first():
    # "abc" ranks below "ab", so a merge can bring up a lower rank than its own.
    ranks = {bytes([i]): i + 1000 for i in range(256)}
    ranks |= {b"ab": 50, b"cab": 10, b"aba": 20, b"bab": 30, b"abab": 5}
    enc = tiktoken.Encoding("own", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
    rnd = random.Random(5)
    texts = ["".join(rnd.choice("abc ") for _ in range(30)) for _ in range(400)]
    for few in (0, 10**9):
        mine = bpe.CorpusBpe(ranks, r"\S+|\s+")
        mine.FEW = few
        assert list(mine.encode(texts)) == [enc.encode_ordinary(t) for t in texts]


def test_op6_query(spark, ranks):
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op6_bpe_roundtrip(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        ids = enc.encode_ordinary(docs[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((docs[r.doc_id] or "").encode()).hexdigest()


def test_encode_decode_frames_and_edges(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (None, "some text", "z"), (2, "", "y")],
                               "doc_id long, text string, ids string")
    tokens = bpe.encode(df.drop("ids"))
    assert sorted(map(str, [(r.doc_id, r.ids) for r in tokens.collect()]))[0].startswith("(1, [])")
    back = bpe.decode(tokens).collect()
    assert collections.Counter(bytes(r.bytes) for r in back) == {b"": 3, b"some text": 1}
    assert bpe.encode(df.where("false")).count() == 0
    assert bpe.encode(df).count() == 4  # a column named like an output is not read


def check_packing(rows, docs, window=1024):
    tk = Tokenizer.from_file(packing.DEFAULT_TOKENIZER)
    ids = {d: [*tk.encode(t or "", add_special_tokens=False).ids, 0] for d, (t, _) in docs.items()}
    per_doc, per_seq = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        per_doc[r.doc_id].append(r)
        per_seq[r.sequence_id].append(r)
        want = np.array(ids[r.doc_id][r.start:r.start + r.length], "<u4").tobytes()
        assert r.ids_crc32 == zlib.crc32(want)
        assert r.doc_tokens == len(ids[r.doc_id])
    assert set(per_doc) == set(docs)
    for d, pieces in per_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at
            at += r.length
        assert at == len(ids[d])
    full = 0
    for s, pieces in per_seq.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
        full += at == window
    assert full >= len(per_seq) - 1
    assert sorted(per_seq) == list(range(len(per_seq)))
    return per_seq


def test_op7_query(spark):
    docs = {r.doc_id: (r.text, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    check_packing(queries.op7_packing(spark, SF).collect(), docs)


def test_packing_keeps_target_shares(spark):
    docs = {k: ("word " * (5 + 13 * k % 400), "ab"[k % 3 == 0]) for k in range(300)}
    df = spark.createDataFrame([(k, t, s) for k, (t, s) in docs.items()],
                               "doc_id long, text string, source string").repartition(5)
    rows = packing.pack(df, window=256, weights={"a": 3, "b": 1}, packet=1).collect()
    seqs = check_packing(rows, docs, 256)
    share = [sum(r.length for r in p if docs[r.doc_id][1] == "b") / 256 for p in seqs.values()]
    both = [s for s in share[:-1] if 0 < s < 1]
    assert len(both) > 40 and all(abs(s - 0.25) < 0.03 for s in share[:len(both) // 2])


def test_deficits_stay_under_a_packet_and_pieces_are_long(spark):
    """At every place of the stream a backlogged source has its share to within a packet of
    each source; pieces are packets cut at most once by a window's end."""
    sources = {"a": 0.5, "b": 0.3, "c": 0.15, "d": 0.05}
    docs = {k: ("word " * (20 + 37 * k % 900), "abcd"[k % 4]) for k in range(800)}
    df = spark.createDataFrame([(k, t, s) for k, (t, s) in docs.items()],
                               "doc_id long, text string, source string").repartition(7)
    rows = packing.pack(df, weights=sources).collect()
    check_packing(rows, docs)
    assert sum(r.length for r in rows) / len(rows) > 140  # of packets of at most 256 and whole shorter documents
    assert all(r.length <= packing.PACKET * 8 for r in rows)
    stream = sorted((r.sequence_id * 1024 + r.offset, r.length, docs[r.doc_id][1]) for r in rows)
    total = collections.Counter()
    for _, n, s in stream:
        total[s] += n
    sent, dry = collections.Counter(), set()
    for at, n, s in stream:
        sent[s] += n
        dry |= {x for x in sources if sent[x] == total[x]}
        if dry:
            break  # from here on the others share the window
        for x, w in sources.items():
            assert abs(sent[x] - w * (at + n)) <= 2 * 1024 * w + packing.PACKET * (1 + len(sources) * w)


def test_many_sources_cost_and_cut_no_more(spark):
    docs = {k: ("token " * (40 + k % 300), f"s{k % 700}") for k in range(2100)}
    df = spark.createDataFrame([(k, t, s) for k, (t, s) in docs.items()], "doc_id long, text string, source string").repartition(3)
    rows = packing.pack(df, with_ids=False).collect()
    check_packing(rows, docs)
    assert len(rows) < 2 * len(docs)  # a document is a packet or two, a window's end cuts one of them


def test_packing_edges(spark):
    docs = {1: (None, None), 2: ("", "x"), 3: ("y" * 5000, None), 4: ("<|endoftext|> a", "x")}
    df = spark.createDataFrame([(k, t, s, 7, 8) for k, (t, s) in docs.items()],
                               "doc_id long, text string, source string, start int, ids int")
    check_packing(packing.pack(df, window=16).collect(), docs, 16)
    assert packing.pack(df.where("false")).count() == 0
