"""What the near-duplicate stage holds in executors: short batches, and memory given back."""

import numpy as np
import psutil
import pyarrow as pa

from loanweave.llm import minhash


def _docs(spark, n=60):
    return spark.createDataFrame([(i, f"one two three four five six seven eight nine ten w{i // 2}") for i in range(n)],
                                 "doc_id long, text string").coalesce(1)


def test_batches_are_short_and_the_setting_goes_back(spark, monkeypatch):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, seen, real = spark.conf.get(name), [], minhash.signatures

    def noted(docs, k):
        seen.append(int(spark.conf.get(name)))
        return real(docs, k)

    monkeypatch.setattr(minhash, "signatures", noted)
    monkeypatch.setattr(minhash, "BATCH_ROWS", 7)  # several batches a task give the rows of one
    got = {(r.doc_id, r.component_id) for r in minhash.near_duplicates(_docs(spark)).collect()}
    assert seen == [7] and spark.conf.get(name) == before
    monkeypatch.setattr(minhash, "BATCH_ROWS", 1000)
    assert got == {(r.doc_id, r.component_id) for r in minhash.near_duplicates(_docs(spark)).collect()}
    assert all(c <= d for d, c in got) and len(got) == 60


def test_a_slice_holds_few_bytes(monkeypatch):
    from loanweave.llm.common import byte_slices
    batch = pa.record_batch([pa.array(range(400)), pa.array(["x" * 10_000] * 400)], ["doc_id", "text"])
    parts = list(byte_slices(batch, 1, minhash.SLICE_BYTES))
    assert sum(p.num_rows for p in parts) == 400 and max(p.num_rows for p in parts) * 10_000 <= minhash.SLICE_BYTES


def test_freed_memory_leaves_the_worker_at_the_end_of_a_partition():
    from loanweave.llm.common import tidy

    def run(batches):
        for b in batches:  # blocks under malloc's own limit, with a small live one on top of them
            many = [np.ones(12_000) for _ in range(2000)]
            keep.append(np.ones(100))
            del many
            yield b

    keep = []
    batch = pa.record_batch([pa.array([1])], ["a"])
    work = tidy(run)(iter([batch]))
    next(work)
    held = psutil.Process().memory_info().rss
    assert list(work) == []
    assert psutil.Process().memory_info().rss <= held
