"""The pipeline stage by stage, each against what its input and plain Python say."""

from __future__ import annotations

import re
import tracemalloc
from pathlib import Path

import numpy as np
import pyarrow as pa

import corpus_pipeline
from postloom.llm import sparse_suffix, words
from postloom.llm.queries import LLM_ORACLE, LLM_REGISTRY
from postloom.llm.storage import BATCH_BYTES, bound_batches, give_back, stored, table
from tests.llm import brute


def test_stages(spark):
    root = "/root/testdata/sf0.01"
    docs = table(spark, root, "documents")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stored(stage(spark, docs, root), f"test-{name}")
        seen[name] = (before, docs)
        if name != "packing":
            assert docs.schema == before.schema
    rows = {n: [(r.doc_id, r.text) for r in a.collect()] for n, (a, _) in seen.items()}
    expected = brute.near_copies(rows["near_copies"], 5, 80)
    assert {d for d, _ in rows["repeats"]} == {d for d, (_, c) in expected.items() if d == c}
    assert not any(cut for _, cut in brute.repeated_words(rows["personal_data"]).values())
    assert not any(brute.base_spans(t) for _, t in rows["packing"])
    assert [d for d, _ in sorted(rows["personal_data"])] == [d for d, _ in sorted(rows["packing"])]
    pieces = seen["packing"][1]
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == {d for d, _ in rows["packing"]}
    whole = LLM_REGISTRY["pipeline"](spark, root)
    key = ["doc_id", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert sorted(map(tuple, whole.select(key).collect())) == sorted(map(tuple, pieces.select(key).collect()))
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" not in LLM_ORACLE


def test_names():
    numbers = {name.split("_")[0] for name in LLM_REGISTRY if name != "pipeline"}
    assert numbers == {f"op{n}" for n in range(1, 11)}
    assert set(LLM_ORACLE) <= set(LLM_REGISTRY)


def test_workers_get_small_batches(spark, frame):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    text = "x" * 100_000

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["bytes"])

    docs = frame([(i, text) for i in range(200)]).coalesce(1)
    tiny = frame([(1, "one two three")])
    own = spark.conf.get(key)
    stages = dict(corpus_pipeline.STAGES)
    try:
        for name in ("quality", "near_copies", "repeats", "packing"):
            spark.conf.unset(key)
            stages[name](spark, tiny, "")
            found = [r.bytes for r in docs.mapInArrow(sizes, "bytes long").collect()]
            assert len(found) > 4 and max(found) <= BATCH_BYTES + 2 * len(text)
        spark.conf.set(key, "1048576b")
        bound_batches(spark)
        assert spark.conf.get(key) == "1048576b"
    finally:
        spark.conf.set(key, own)


def test_texts_are_worked_through_in_little_memory(monkeypatch):
    monkeypatch.setattr(words, "_powers", {})
    rng = np.random.default_rng(5)
    texts = pa.array([" ".join(f"w{n}" for n in rng.integers(0, 9_999, 300)) for _ in range(2_000)])
    tracemalloc.start()
    for run in words.slices(texts):
        found, hashed = sparse_suffix._read(run)
        sparse_suffix._keys(hashed, np.unique(sparse_suffix._minimisers(found, hashed)[1]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert texts.nbytes > 3 << 20 and peak < 24 << 20


def test_freed_memory_is_given_back():
    def held():
        found = re.findall(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())
        return sum(map(int, found)) / 1024

    blocks = [bytes(2_000) for _ in range(50_000)]
    few = blocks[::50]  # between the freed ones, so that the heap does not shrink by itself
    del blocks
    before = held()
    give_back()
    assert held() < before - 60 and len(few) == 1_000
