"""Corpus pipeline: raw documents to packed training sequences.

Five stages, each written to the shared folder and read again by the next:
language identification, toxicity filter, near-duplicate removal, redaction of
personal data, packing.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loanweave.llm import langid, minhash, packing, pii, toxicity
from loanweave.llm.common import ship_package, stage, table
from loanweave.session import prepare_session

#: No lead over the next language is asked for: short clean texts often give the
#: same few phrases in two languages, and a tie has a defined language.
MIN_LANGUAGE_LEAD = 0.0


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (null, empty, no letters) go."""
    ship_package(spark)
    return langid.keep_identified(docs, langid.training_text(docs), MIN_LANGUAGE_LEAD)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the clause grammar scores at its threshold or above go."""
    ship_package(spark)
    return toxicity.keep_civil(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the row with the smallest doc_id stays, and of rows
    that agree in doc_id and text one.  Rows that share a doc_id but not the text are
    documents of their own; rows without a doc_id stay."""
    ship_package(spark)
    tag = uuid.uuid4().hex  # no column of the input has such a name
    node, text_hash = f"node_{tag}", f"hash_{tag}"
    named = docs.where("doc_id is not null").withColumn(text_hash, F.xxhash64("text"))
    several = stage(named.groupBy(F.col("doc_id").alias(f"id_{tag}")).agg(F.min(text_hash).alias(f"first_{tag}"), F.max(text_hash).alias("top"))
                    .where(F.col(f"first_{tag}") != F.col("top")).drop("top"), "pipeline_shared_ids")
    if several.limit(1).count():
        # Such a doc_id names the text first in hash order; the others get numbers beyond all ids.
        other = F.lit(1 << 62) + F.col(text_hash).bitwiseAND(F.lit((1 << 61) - 1))
        named = named.join(several, F.col("doc_id") == F.col(f"id_{tag}"), "left").withColumn(
            node, F.when(F.col(text_hash) != F.col(f"first_{tag}"), other).otherwise(F.col("doc_id")))
    else:
        named = named.withColumn(node, F.col("doc_id"))
    kept = minhash.near_duplicates(named.select(F.col(node).alias("doc_id"), "text")).where("kept").select(
        F.col("doc_id").alias(f"kept_{tag}")).distinct()
    line = Window.partitionBy(node, text_hash).orderBy(F.lit(0))
    single = (named.join(kept, F.col(node) == F.col(f"kept_{tag}"), "left_semi")
              .withColumn(f"row_{tag}", F.row_number().over(line)).where(F.col(f"row_{tag}") == 1).select(*docs.columns))
    return single.unionByName(docs.where("doc_id is null"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data is replaced by its kind."""
    return pii.redact(docs, pii.fit(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their ids and places in the packed sequences."""
    ship_package(spark)
    return packing.pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("toxicity", drop_toxic),
    ("minhash_dedup", drop_near_duplicates),
    ("pii", redact_personal_data),
    ("packing", pack_sequences),
]

#: SQL cannot state the learned stages; tests compare each with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    prepare_session(spark)
    docs = table(spark, sf_dir, "documents")
    for name, fn in STAGES[:-1]:
        docs = stage(fn(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
