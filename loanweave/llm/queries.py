"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanweave.llm import bpe, chat, discriminant, hnsw, langid, lexical, minhash, packing, pii, quality, toxicity, warc, whitening
from loanweave.llm.common import ship_package, stage, table
from loanweave.session import prepare_session


def _prepared(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare_session(spark)
    ship_package(spark)
    return table(spark, sf_dir, name)


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _prepared(spark, sf_dir, "documents")


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 4-word shingle sets are 0.8 similar."""
    return minhash.near_duplicates(_docs(spark, sf_dir), k=4)


def op2_pii_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base spans of every text, and those that the boosted trees add."""
    docs = _docs(spark, sf_dir).select("doc_id", "text")
    found = pii.find(docs, pii.fit(docs))

    def count(kind: str):
        return F.size(F.filter("pii_base", lambda c: c["k"] == pii.KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[count(k) for k in pii.KINDS],
                        F.sha2(pii.said(F.col("pii_base")).cast("binary"), 256).alias("base_sha256"),
                        pii.said(F.col("pii_spans")).alias("spans"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text by cross-parsing against labelled text."""
    docs = _docs(spark, sf_dir)
    found = langid.predict(docs, langid.training_text(docs))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op4_chat_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation against its variant with the next one's replies."""
    chosen, rejected = chat.neighbour_pairs(_prepared(spark, sf_dir, "conversations"))
    said = F.transform  # masks as start:end lists, so that SQL can state them

    def spans(mask: str):
        return F.array_join(said(mask, lambda m: F.concat_ws(":", m["start"].cast("string"), m["end"].cast("string"))), ",")

    return chat.format_preferences(chosen, rejected).select(
        "pair_id", "n_common", "prompt", "chosen", spans("chosen_mask").alias("chosen_mask"),
        "rejected", spans("rejected_mask").alias("rejected_mask"))


def op5_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page archived, read back and verified."""
    pages = _prepared(spark, sf_dir, "pages")
    path = warc.archive_path(spark)
    warc.write_archive(pages, path)
    records = warc.read_archive(spark, path, pages.schema["page_id"].dataType.simpleString())
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
                          F.assert_true("verified").isNull().alias("verified"))


def op6_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded by corpus-level merge replay and decoded again."""
    names = [str(i) for i in range(1 << 16)]

    def digest(enc: bpe.CorpusBpe, ids: list[int]) -> tuple:
        said = " ".join([names[i] for i in ids])
        return (len(ids), hashlib.sha256(said.encode()).hexdigest(),
                hashlib.sha256(enc.decode(ids)).hexdigest())

    return bpe.map_tokens(_docs(spark, sf_dir), digest, [
        ("n_tokens", pa.int64(), "bigint"), ("ids_sha256", pa.string(), "string"),
        ("decoded_sha256", pa.string(), "string")])


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_docs(spark, sf_dir), with_ids=False)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text scored by the clause grammar with learned insult stems."""
    docs = _docs(spark, sf_dir)
    found = toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "score",
                        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of vectors at cosine 0.9, through graphs per shard."""
    return hnsw.link_embeddings(_prepared(spark, sf_dir, "embeddings"))


def op10_quality_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules, then the distance from the robust estimate of language and source."""
    return quality.score_quality(_docs(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leading whitened coordinates of every vector, from the bit-sliced scatter of all."""
    vectors = _prepared(spark, sf_dir, "embeddings")
    model = whitening.fit(vectors.select("embedding"))
    id_type = vectors.schema["vec_id"].dataType.simpleString()
    if model is None:
        return spark.createDataFrame([], f"vec_id {id_type}, component int, n long, deviation long, whitened double, "
                                         "explained double, identity_error double")
    share = F.array(*[F.lit(float(e / model.trace) if model.trace else 0.0) for e in model.eigenvalues])
    return (whitening.whiten(vectors, model)
            .select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
            .select("vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"),
                    F.col("deviation").try_cast("long").alias("deviation"), "whitened", F.get(share, F.col("at")).alias("explained"),
                    F.lit(whitening.identity_error(vectors.select("embedding"), model)).alias("identity_error")))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten highest-scoring documents of all for every benchmark item."""
    return lexical.search(_prepared(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))


def op13_quality_discriminant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text scored for quality by the shrunken class densities of its statistics."""
    stats = stage(discriminant.text_statistics(_docs(spark, sf_dir)), "discriminant_stats")
    found = discriminant.score(stats, discriminant.learn(stats, table(spark, sf_dir, "labels")))
    return found.select("doc_id", discriminant.held_out(F.col("doc_id")).alias("held_out"), "score",
                        (F.col("score") >= discriminant.THRESHOLD).cast("int").alias("predicted"))


QUERIES = {
    "op1_minhash_dedup": op1_minhash_dedup,
    "op2_pii_boosting": op2_pii_boosting,
    "op3_language_id": op3_language_id,
    "op4_chat_preferences": op4_chat_preferences,
    "op5_warc_archive": op5_warc_archive,
    "op6_bpe_roundtrip": op6_bpe_roundtrip,
    "op7_packing": op7_packing,
    "op8_toxicity": op8_toxicity,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op10_quality_outliers": op10_quality_outliers,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_lexical_search": op12_lexical_search,
    "op13_quality_discriminant": op13_quality_discriminant,
}

ORACLE_SQL: dict[str, str] = {
    "op1_minhash_dedup": r"""
        WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
             s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                       ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS g FROM d),
             n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
             often AS (SELECT g FROM s GROUP BY g HAVING count(*) > 1),
             t AS (SELECT doc_id, g FROM s SEMI JOIN often USING (g)),
             p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM t a JOIN t b USING (g)
                   WHERE a.doc_id <> b.doc_id GROUP BY ALL),
             e AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= 80 * (a.n + b.n - k)),
             r AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, e.y FROM r JOIN e ON e.x = r.y),
             c AS (SELECT x AS doc_id, min(y) AS component_id FROM r GROUP BY x)
        SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
        FROM c LEFT JOIN n USING (doc_id)
    """,
    "op4_chat_preferences": """
        WITH c AS (SELECT conv_id AS p, turn, role, text,
                          row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) - 1 AS pos
                   FROM conversations WHERE conv_id IS NOT NULL),
             k AS (SELECT conv_id AS p, list_sort(list(DISTINCT turn) FILTER (WHERE role = 'assistant' AND turn IS NOT NULL)) AS t
                   FROM conversations WHERE conv_id IS NOT NULL GROUP BY ALL),
             o AS (SELECT conv_id - 1 AS p, turn, min(text) AS text FROM conversations WHERE role = 'assistant' GROUP BY ALL),
             x AS (SELECT c.p, c.turn, c.role, CASE WHEN c.turn >= coalesce(k.t[2], k.t[1]) THEN coalesce(o.text, c.text) ELSE c.text END AS text
                   FROM c JOIN k USING (p) LEFT JOIN o ON o.p = c.p AND o.turn = c.turn AND c.role = 'assistant'),
             r AS (SELECT *, row_number() OVER (PARTITION BY p ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) - 1 AS pos FROM x),
             b AS (SELECT c.p, c.pos, coalesce(c.role, 'user') AS cr, coalesce(c.text, '') AS ct,
                          coalesce(r.role, 'user') AS rr, coalesce(r.text, '') AS rt FROM c JOIN r USING (p, pos)),
             n AS (SELECT p, coalesce(min(pos) FILTER (WHERE cr <> rr OR ct <> rt), max(pos) + 1) AS n FROM b GROUP BY p),
             w AS (SELECT p, pos, n, pos < n AS common, cr, rr, '<|' || cr || '|>' || chr(10) || ct || chr(10) || '<|end|>' || chr(10) AS cs,
                          '<|' || rr || '|>' || chr(10) || rt || chr(10) || '<|end|>' || chr(10) AS rs FROM b JOIN n USING (p)),
             z AS (SELECT *, coalesce(sum(length(cs)) FILTER (WHERE NOT common) OVER u, 0) AS ce,
                          coalesce(sum(length(rs)) FILTER (WHERE NOT common) OVER u, 0) AS re
                   FROM w WINDOW u AS (PARTITION BY p ORDER BY pos))
        SELECT p AS pair_id, n AS n_common,
               coalesce(string_agg(cs, '' ORDER BY pos) FILTER (WHERE common), '') AS prompt,
               coalesce(string_agg(cs, '' ORDER BY pos) FILTER (WHERE NOT common), '') AS chosen,
               coalesce(string_agg((ce - length(cs) + length(cr) + 5)::BIGINT || ':' || ce::BIGINT, ',' ORDER BY pos)
                        FILTER (WHERE NOT common AND cr = 'assistant'), '') AS chosen_mask,
               coalesce(string_agg(rs, '' ORDER BY pos) FILTER (WHERE NOT common), '') AS rejected,
               coalesce(string_agg((re - length(rs) + length(rr) + 5)::BIGINT || ':' || re::BIGINT, ',' ORDER BY pos)
                        FILTER (WHERE NOT common AND rr = 'assistant'), '') AS rejected_mask
        FROM z GROUP BY p, n
    """,
    "op9_embedding_dedup": """
        WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
                             WHERE len(embedding) > 0 AND list_count(embedding) = len(embedding)
                               AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0
                               AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
             l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
                   WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
             r AS (SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT r.x, l.y FROM r JOIN l ON l.x = r.y),
             c AS (SELECT x AS vec_id, min(y) AS component_id FROM r GROUP BY x),
             d AS (SELECT x AS vec_id, count(*) AS n_links FROM l GROUP BY x)
        SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
        FROM c LEFT JOIN d USING (vec_id)
    """,
    "op5_warc_archive": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
             d AS (SELECT page_id, strlen(h) AS n, max(page_id) OVER (PARTITION BY h) AS top,
                          list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                              ((('0x' || substr(x, 1 + 5 * (i // 4), 5))::INT >> (15 - 5 * (i % 4))) & 31)::INT + 1, 1)),
                              'string_agg', '') AS digest
                   FROM p)
        SELECT page_id, n AS payload_bytes, digest AS payload_digest,
               CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> top THEN top END AS refers_to, true AS verified
        FROM d
    """,
    "op12_lexical_search": r"""
        WITH d AS (SELECT doc_id, row_number() OVER () AS r,
                          regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS x FROM documents),
             c AS (SELECT count(*) AS nd, sum(len(x))::BIGINT AS nt FROM d WHERE len(x) > 0),
             i AS (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                       'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
             q AS (SELECT item_id, t, count(*) AS q FROM i GROUP BY ALL),
             p AS (SELECT r, doc_id, n, t, count(*) AS tf FROM (SELECT r, doc_id, len(x) AS n, unnest(x) AS t FROM d)
                   SEMI JOIN q USING (t) GROUP BY ALL),
             f AS (SELECT t, floor(1000 * ln((2 * max(nd) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM p, c GROUP BY t),
             s AS (SELECT item_id, r, doc_id,
                          sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * nd) // nt))))::BIGINT AS score
                   FROM q JOIN p USING (t) JOIN f USING (t), c GROUP BY ALL HAVING score > 0),
             k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s)
        SELECT item_id, rank::INT AS rank, doc_id, score FROM k WHERE rank <= 10
    """,
}
