"""What Python workers hold, and what they keep for the next stage."""

import random
import tracemalloc
import weakref

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SMALL_SF_DIR
from tallyhall.llm import passages, tokens
from tallyhall.llm.common import BATCH_BYTES, read_table
from tallyhall.session import checkpoint_dir

BPE = tokens.public_path("word_bpe_49k.json")


def seed_task(monkeypatch, buckets):
    """The function that ``seeds`` runs in a worker."""
    class Docs:
        def mapInArrow(self, run, schema):
            return run
    monkeypatch.setattr(passages, "_plain", lambda docs: docs)
    return passages.seeds(Docs(), buckets)


def batch(texts, first=0):
    return pa.RecordBatch.from_arrays([pa.array(range(first, first + len(texts)), pa.int64()), pa.array(texts)],
                                      names=["id", "text"])


def test_seeds_of_a_chunk_take_little_memory(monkeypatch):
    rnd = random.Random(3)
    words = [f"w{k}" for k in range(20_000)]
    batches = [batch([" ".join(rnd.choices(words, k=1000)) for _ in range(50)], 50 * k) for k in range(20)]
    monkeypatch.setattr(passages, "CHUNK", 1_000_000)
    task = seed_task(monkeypatch, 50)
    tracemalloc.start()
    try:
        assert sum(b.num_rows for b in task(iter(batches))) == 50
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 100 * 1_000_000  # bytes a word


def test_a_worker_lets_go_of_the_encoder_at_another_operators_task(monkeypatch):
    gone = weakref.ref(tokens.encoder(BPE))
    assert gone() is tokens.encoder(BPE)
    list(seed_task(monkeypatch, 4)(iter([batch(["a b c"])])))
    assert gone() is None


def test_stages_work_in_batches_bounded_by_bytes(spark):
    checkpoint_dir(spark)
    session = spark.newSession()
    corpus_pipeline.pack_sequences(session, read_table(session, SMALL_SF_DIR, "documents").limit(20), SMALL_SF_DIR)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes], pa.int64())], names=["n"])

    texts = session.range(0, 9000, 1, 1).select(F.repeat(F.lit("x"), 3000).alias("text"))
    found = [r["n"] for r in texts.mapInArrow(sizes, "n long").collect()]
    assert sum(found) >= 9000 * 3000
    assert max(found) < 1.5 * BATCH_BYTES


@pytest.mark.parametrize("step", [1, 7, 64])
def test_hashes_by_steps_equal_those_at_once(monkeypatch, step):
    rng = np.random.default_rng(step)
    for total in (0, 4, 5, 49, 50, 51, 400):
        words = rng.integers(0, 30, total).astype(np.uint32)
        size = np.array([total // 3, 0, total - total // 3])
        start = np.cumsum(size) - size
        monkeypatch.setattr(passages, "STEP", 1 << 30)
        whole = passages.kmer_hashes(words), *passages.long_seeds(words, start, size)
        monkeypatch.setattr(passages, "STEP", step)
        parts = passages.kmer_hashes(words), *passages.long_seeds(words, start, size)
        for a, b in zip(whole, parts):
            assert a.tolist() == b.tolist()
