"""What a task holds at once while it hashes words and cuts passages, and the batches it is given."""

import tracemalloc

import numpy as np
import pyarrow as pa

import corpus_pipeline
from lamina.llm import minhash, substring
from lamina.llm.store import BATCH_BYTES, light_batches

TEXTS = [" ".join(f"w{(i * 7919 + k) % 5000}" for k in range(400)) for i in range(2000)]  # 4 MB


def peak(run, batch):
    list(run(iter([batch.slice(0, 2)])))  # what a worker keeps
    tracemalloc.start()
    for _ in run(iter([batch])):
        pass
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return most / 1e6


def test_memory_of_a_task_is_that_of_a_slice():
    n = len(TEXTS)
    rows, texts = pa.array(np.arange(n)), pa.array(TEXTS)
    spans = pa.array([[{"start": 0, "stop": 40}]] * n, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])))
    batch = pa.RecordBatch.from_arrays([rows, rows, texts, spans], ["row_key", "doc_id", "text", "spans"])
    assert peak(substring._anchors(35), batch) < 20
    assert peak(minhash._signatures(5), batch) < 20
    assert peak(substring._strip(35, True), batch) < 60


def test_a_stage_asks_for_light_batches(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "64m")
        docs = spark.createDataFrame([(1, "a b c", "en", "web", 5)], "doc_id long, text string, lang string, source string, n_chars int")
        corpus_pipeline.cut_recurring_passages(spark, docs, "/root/testdata/sf0.001")
        assert spark.conf.get(name) == str(BATCH_BYTES)
        spark.conf.set(name, "1000")
        light_batches(spark)
        assert spark.conf.get(name) == "1000"
    finally:
        spark.conf.set(name, before)
