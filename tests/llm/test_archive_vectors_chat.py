"""Web archive, embeddings, chat formatting and the pipeline."""

import base64
import hashlib
import math
import os
import random
import sys
import tracemalloc

import duckdb
import numpy as np
import pytest

from loanweave.llm import chat, common, hnsw, packing, queries, warc

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got = queries.QUERIES[name](spark, SF)
    want = con.execute(queries.ORACLE_SQL[name]).to_arrow_table()
    cols = sorted(got.columns)
    assert cols == sorted(want.column_names)
    rows = sorted((tuple(r[c] for c in cols) for r in got.collect()), key=str)
    assert rows == sorted(zip(*(want[c].to_pylist() for c in cols)), key=str)


def test_archive_round_trip_and_files(spark, tmp_path):
    html = ["<p>a</p>", "<p>a</p>", "", None, "é\r\n\r\nx", "<p>a</p>", "big " * 40000]
    rows = [(i, f"http://h/{i}", t, "x") for i, t in enumerate(html)] + [(6, "http://h/6", html[6], "x"), (None, None, "<p>a</p>", "x"), (9, "a\r\nb", "solo", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload string")
    path = str(tmp_path / "arc")
    warc.write_archive(pages, path)
    got = warc.read_archive(spark, path).collect()
    assert len(got) == len(rows) and all(r.verified for r in got)
    by = {r.page_id: r for r in got}
    for i, t in enumerate(html):
        raw = (t or "").encode()
        assert bytes(by[i].payload) == raw and by[i].payload_bytes == len(raw)
        assert by[i].payload_digest == base64.b32encode(hashlib.sha1(raw).digest()).decode()
    assert (by[0].record_type, by[0].refers_to, by[5].record_type, by[5].refers_to) == ("revisit", 5, "response", None)
    assert (by[2].refers_to, by[3].record_type, by[None].refers_to) == (3, "response", 5)
    assert by[9].url == "a%0D%0Ab" and sum(r.page_id == 6 and r.record_type == "response" for r in got) == 2
    assert spark.read.parquet(f"{path}/payloads").count() == 5  # each payload once
    warc.export_warc(warc.read_archive(spark, path).repartition(2), str(tmp_path / "files"))
    back = warc.import_warc(spark, str(tmp_path / "files")).collect()
    assert len(back) == len(rows)
    assert {bytes(r.payload) for r in back if r.record_type == "response"} == {(t or "").encode() for t in [*html, "solo"]}
    small = str(tmp_path / "small")
    warc.write_archive(pages, small, min_revisit_bytes=100)
    assert {r.record_type for r in warc.read_archive(spark, small).collect()} == {"response"}
    none = str(tmp_path / "none")
    warc.write_archive(pages.where("false"), none)
    assert warc.read_archive(spark, none).count() == 0


def brute_links(vectors):
    out = {}
    for i, x in vectors:
        for j, y in vectors:
            if i != j and len(x) == len(y):
                dot = sum(a * b for a, b in zip(x, y)) / math.sqrt(sum(a * a for a in x)) / math.sqrt(sum(b * b for b in y))
                if dot >= 0.9:
                    out.setdefault(i, set()).add(j)
    return out


@pytest.mark.parametrize("shard_rows,query_rows", [(8192, 16384), (90, 70)])
def test_embedding_links_equal_brute_force(spark, shard_rows, query_rows):
    rnd = np.random.default_rng(4)
    base = rnd.normal(size=(12, 16))
    x = np.concatenate([np.repeat(base, 25, axis=0) + rnd.normal(size=(300, 16)) * 0.12, rnd.normal(size=(150, 16))]).astype(np.float32)
    rows = [(i, [float(a) for a in v]) for i, v in enumerate(x)] + [(900, [float(a) for a in x[7]]), (901, [2 * float(a) for a in x[7]])]
    odd = [(950, None), (951, [0.0] * 16), (952, [1.0, None] * 8), (953, [float("nan")] * 16), (954, []), (955, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, "l") for i, v in rows + odd], "vec_id long, embedding array<float>, n_links string")
    got = {r.vec_id: r for r in hnsw.link_embeddings(df, shard_rows=shard_rows, query_rows=query_rows).collect()}
    links = brute_links(rows)
    found = sum(got[i].n_links for i, _ in rows)
    total = sum(len(v) for v in links.values())
    assert found == total and all(got[i].n_links == len(links.get(i, ())) for i, _ in rows)
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i, _ in odd)
    seen = {}
    for i, _ in rows:
        stack, comp = [i], {i}
        while stack:
            for j in links.get(stack.pop(), ()):
                if j not in comp:
                    comp.add(j)
                    stack.append(j)
        seen[i] = min(comp)
    assert {i: got[i].component_id for i, _ in rows} == seen


def test_embedding_edges(spark):
    df = spark.createDataFrame([(None, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.99, 0.01])], "vec_id long, embedding array<double>")
    got = [(r.vec_id, r.n_links, r.component_id, r.kept) for r in hnsw.link_embeddings(df).collect()]
    assert sorted(got, key=str) == sorted([(None, 0, None, True), (2, 1, 2, True), (2, 1, 2, True), (3, 1, 2, False)], key=str)
    assert hnsw.link_embeddings(df.where("false")).count() == 0


def test_embedding_group_of_near_copies_is_joined_without_its_pairs():
    n = 3000
    rnd = np.random.default_rng(6)
    unit = hnsw._unit(np.concatenate([rnd.normal(size=16) + rnd.normal(size=(n, 16)) * 0.01, rnd.normal(size=(50, 16))]))
    ids = rnd.permutation(len(unit)) + 7
    copies = np.where(np.arange(len(unit)) == 5, 3, 1)
    g = hnsw.Graph.build(unit.astype(np.float32), ids)
    ef = g.audited_beam(unit.astype(np.float32), ids, 0.9)
    tracemalloc.start()
    own, others, child, root = hnsw.join_links(g, unit, ids, copies, unit, ids, ef, 0.9)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    group = dict(zip(ids[:n].tolist(), (n + 2 - copies[:n]).tolist()))
    got = dict(zip(own.tolist(), others.tolist()))
    assert {i: got[i] for i in group} == group
    first = min(group)
    assert {c: r for c, r in zip(child.tolist(), root.tolist()) if c in group} == {i: first for i in group if i != first}
    assert len(child) <= len(unit) and peak < 16 * n * n  # a tuple a directed link takes 72 bytes and more


def test_preferences(spark):
    c = [(1, 0, "system", "s"), (1, 1, "user", "hi"), (1, 2, "assistant", "good"), (2, 0, "user", "a"), (3, 0, None, None), (4, 0, "user", "only"),
         (None, 0, "user", "x"), (5, 1, "user", "same"), (5, 1, "user", "same")]
    r = [(1, 0, "system", "s"), (1, 1, "user", "hi"), (1, 2, "assistant", "bad"), (1, 3, "user", "?"), (2, 0, "user", "b"), (3, 0, None, None),
         (5, 1, "user", "same"), (5, 1, "user", "same")]
    kind = "pair_id long, turn int, role string, text string"
    rows = {x.pair_id: x for x in chat.format_preferences(spark.createDataFrame(c, kind), spark.createDataFrame(r, kind)).collect()}
    x = rows[1]
    assert x.n_common == 2 and x.prompt == "<|system|>\ns\n<|end|>\n<|user|>\nhi\n<|end|>\n"
    assert x.chosen == "<|assistant|>\ngood\n<|end|>\n" and x.rejected.endswith("<|user|>\n?\n<|end|>\n")
    assert [x.chosen[m.start:m.end] for m in x.chosen_mask] == ["good\n<|end|>\n"]
    assert [x.rejected[m.start:m.end] for m in x.rejected_mask] == ["bad\n<|end|>\n"]
    assert rows[2].n_common == 0 and rows[2].prompt == "" and list(rows[2].chosen_mask) == []
    assert rows[3].n_common == 1 and rows[3].chosen == rows[3].rejected == "" and rows[3].prompt == "<|user|>\n\n<|end|>\n"
    assert rows[4].n_common == 0 and rows[4].rejected is None and rows[4].chosen.startswith("<|user|>\nonly")
    assert rows[5].n_common == 2 and set(rows) == {1, 2, 3, 4, 5}
    empty = spark.createDataFrame([], kind)
    assert chat.format_preferences(empty, empty).count() == 0


def test_language_stage_keeps_short_and_tied_texts(spark):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    import corpus_pipeline
    from loanweave.llm import langid

    text_of = {"en": "this is a cat and an animal", "fr": "ceci est un chat de la maison, il a un animal"}
    rows = [(i, t, lang) for i, (lang, t) in enumerate([*text_of.items()] * 8)]
    rows += [(100, "A.", "en"), (101, "animal", "fr"), (102, "this is ceci est", "en"), (103, "12 34", "en"), (104, None, "fr")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert 0.0 in langid.CrossParser(langid.training_text(df)).predict(["A.", "animal"])[1]
    assert {r.doc_id for r in corpus_pipeline.identify_language(spark, df, SF).collect()} == {r[0] for r in rows} - {103, 104}


def test_pipeline_stages(spark):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    import corpus_pipeline
    from loanweave.llm import langid, minhash, pii, toxicity

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(10**9, "12 34", "en", "x", 5), (10**9 + 1, None, None, None, None)], docs.schema)
    docs = docs.unionByName(extra).unionByName(docs.where("doc_id = 3"))
    # Further columns, named like outputs and working columns, must come through as they are.
    docs = docs.withColumn("pii_spans", docs.doc_id).withColumn("kept", docs.source).withColumn("score", docs.n_chars).cache()
    rows = {r.doc_id: r for r in docs.collect()}
    at = {}
    frame = docs
    for name, fn in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in frame.collect()} if name != "packing" else None
        out = fn(spark, frame, SF).cache()
        if name != "packing":
            assert out.columns == docs.columns
            at[name] = (before, {r.doc_id: r for r in out.collect()}, out.count())
            assert all((r.pii_spans, r.kept) == (rows[d].pii_spans, rows[d].kept) for d, r in at[name][1].items())
        frame_before, frame = frame, out
    before, after, _ = at["language_id"]
    parser = langid.CrossParser(langid.training_text(docs))
    lang, score = parser.predict([r.text for r in before.values()])
    assert set(after) == {d for d, x, s in zip(before, lang, score) if x != "und" and s >= corpus_pipeline.MIN_LANGUAGE_LEAD}
    assert 10**9 not in after and len(after) >= 0.95 * len(rows)
    before, after, _ = at["toxicity"]
    labels = dict(duckdb.sql(f"select doc_id, toxic from '{SF}/labels.parquet'").fetchall())
    assert after and set(after) < set(before)
    assert all(labels.get(d) != 0 for d in set(before) - set(after))
    before, after, n = at["minhash_dedup"]
    from .test_documents import components
    want = components([(d, r.text) for d, r in before.items()], minhash.SHINGLE)
    assert set(after) == {d for d, (_, c) in want.items() if c == d} and n == len(after)
    before, after, _ = at["pii"]
    from .test_documents import base_spans
    assert set(before) == set(after)
    assert all(not base_spans(r.text) for r in after.values())
    assert all(after[d].text == r.text for d, r in before.items() if not base_spans(r.text))
    pieces = frame.collect()
    assert {r.doc_id for r in pieces} == set(after)
    assert sum(r.length for r in pieces) == sum({r.doc_id: r.doc_tokens for r in pieces}.values())
    assert all(r.length == len(r.ids) and r.offset + r.length <= packing.WINDOW for r in pieces)
    assert toxicity.THRESHOLD == 0.3 and pii.KINDS[0] == "email"


# ---- hot keys ------------------------------------------------------------------------

@pytest.fixture
def small_skew(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.files.maxPartitionBytes": "16k",
            "spark.sql.files.openCostInBytes": "1k"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hub_of_half_the_links_is_split(spark, small_skew, monkeypatch):
    links = [(0, i) for i in range(1, 6000)] + [(10000 + i, 10001 + i) for i in range(0, 3000, 2)]
    plans = {}

    def recording(df, label):
        df.collect()
        plans.setdefault(label, df._jdf.queryExecution().executedPlan().toString())
        return stage(df, label)

    stage = common.stage
    monkeypatch.setattr(common, "stage", recording)
    got = {r.node: r.component_id for r in common.connected_components(spark.createDataFrame(links, "a long, b long").repartition(8)).collect()}
    assert all(got[i] == 0 for i in range(6000)) and got[10001] == got[10000] == 10000
    assert "skew=true" in plans["cc_large"]


def test_hot_digest_is_split(spark, small_skew, monkeypatch, tmp_path):
    rows = [(i, f"http://h/{i}", "same page" if i < 6000 else f"page {i}") for i in range(9000)]
    plans = []

    def recording(*args, **kw):
        df = join(*args, **kw)
        df.collect()
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    join = warc.join_aggregate
    monkeypatch.setattr(warc, "join_aggregate", recording)
    path = str(tmp_path / "arc")
    frame = str(tmp_path / "pages")
    spark.createDataFrame(rows, "page_id long, url string, html string").repartition(12).write.parquet(frame)
    warc.write_archive(spark.read.parquet(frame), path)
    assert "skew=true" in plans[0]
    kinds = warc.read_archive(spark, path).groupBy("record_type").count().collect()
    assert {r["record_type"]: r["count"] for r in kinds} == {"response": 3001, "revisit": 5999}
