"""Trees are fitted on every document; an archive's shuffle files go before it is read."""

import tempfile

from pyspark.sql import functions as F

from loanweave.llm import pii, warc


def test_pii_counts_come_from_every_document(spark, monkeypatch):
    n, seen = 25_000, []

    def stage(df, label):
        seen.append(df)
        return real(df, label)

    real = pii.stage
    monkeypatch.setattr(pii, "stage", stage)
    docs = spark.range(n).select(F.concat(F.lit("row "), F.col("id") + 5000, F.lit(" of 1, 2, 3, 4 units")).alias("text"))
    assert pii.fit(docs.unionByName(spark.sql("select cast(null as string) as text"))).trees == []  # no true candidate
    assert seen[0].agg(F.sum("n")).first()[0] == n
    assert pii.fit(docs.where("false")).trees == []


def test_archive_leaves_no_shuffle_files_of_its_writing(spark):
    def shuffles():
        env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
        return env.blockManager().diskBlockManager().getAllFiles().mkString(",").count("shuffle_")

    pages = spark.range(200).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), (F.col("id") % 50).cast("string").alias("html"))
    path, before = tempfile.mkdtemp(prefix="warc-") + "/a", shuffles()
    warc.write_archive(pages, path)
    assert shuffles() <= before
    assert warc.read_archive(spark, path).where("verified").count() == 200
