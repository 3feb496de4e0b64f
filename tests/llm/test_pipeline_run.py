"""corpus_pipeline.run: the chain of written stages, a rerun, an empty table, shared ids."""

import os
import sys

import pytest

SF = "/root/testdata/sf0.001"
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture(scope="module")
def pipeline():
    import corpus_pipeline
    return corpus_pipeline


def folder(spark, tmp_path, docs):
    path = str(tmp_path / "in")
    docs.write.parquet(f"{path}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{path}/labels.parquet")
    return path


def test_run_covers_what_the_stages_keep_and_repeats(spark, pipeline, tmp_path):
    path = folder(spark, tmp_path, spark.read.parquet(f"{SF}/documents.parquet").repartition(3))
    first = sorted(map(tuple, pipeline.run(spark, path).drop("ids").collect()))
    assert first == sorted(map(tuple, pipeline.run(spark, path).drop("ids").collect()))
    ids = {r[0] for r in first}
    n_docs = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert 0.5 * n_docs < len(ids) < n_docs


def test_run_on_an_empty_table(spark, pipeline, tmp_path):
    path = folder(spark, tmp_path, spark.read.parquet(f"{SF}/documents.parquet").limit(0))
    out = pipeline.run(spark, path)
    assert out.collect() == [] and "sequence_id" in out.columns


def test_rows_that_share_an_id_but_not_the_text_all_stay(spark, pipeline):
    text = [" ".join(f"{w}{i}" for w in "abcdefghijklmnopqrst") for i in range(4)]
    rows = [(1, text[0], "x"), (1, text[1], "y"), (1, text[1], "y"), (2, text[2], "z"), (3, text[2], "copy"), (None, text[0], "n"),
            (5, text[1] + " more", "near"), (6, None, "e"), (6, "", "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted((str(r.doc_id), r.text or "") for r in pipeline.drop_near_duplicates(spark, docs, "").collect())
    texts = [t for _, t in got]
    assert ("1", text[0]) in got and ("2", text[2]) in got and ("3", text[2]) not in got and ("None", text[0]) in got
    # the second text of id 1 and its near copy are one group: one of the two stays
    assert (("1", text[1]) in got) + (("5", text[1] + " more") in got) == 1 and texts.count(text[1]) <= 1
    assert [d for d, _ in got].count("6") == 2
