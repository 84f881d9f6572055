"""Shards: each record once, even counts, the same order again, and a fair shuffle."""

from __future__ import annotations

import zlib

import numpy as np

from postloom.llm import external_shuffle
from postloom.llm.external_shuffle import fisher_yates, shard_digests, shuffled, write_shards
from tests.llm.conftest import ODD


def _check(found, rows, shards):
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in found) == sorted(
        (str(d), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in rows
    )
    slots: dict = {}
    for r in found:
        slots.setdefault(r.shard, []).append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and set(slots) <= set(range(shards))


def test_whole_table(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = shard_digests(docs).collect()
    _check(found, rows, 40)
    again = shard_digests(docs).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in found} == {(r.doc_id, r.shard, r.slot) for r in again}


def test_buckets_of_one_hot_text(frame):
    rows = [(i, "same text" if i % 3 else f"text {i}") for i in range(2_000)] + [(5, "same text")] * 900
    found = shuffled(frame(rows).select("doc_id", "text"), 7, bucket_bytes=4_000).collect()
    order = sorted(range(len(found)), key=lambda i: (found[i].shard, found[i].slot))
    ids = np.array([found[i].doc_id for i in order])
    assert len(found) == len(rows)
    # Neighbours in the input are far apart in the output.
    place = {d: i for i, d in enumerate(ids) if d != 5}
    gaps = [abs(place[i] - place[i + 1]) for i in range(6, 1_998)]
    assert np.mean(gaps) > 600


def test_fisher_yates_is_even():
    counts = np.zeros((4, 4))
    for seed in range(4_000):
        counts[np.arange(4), fisher_yates(4, [seed, 1])] += 1
    assert np.abs(counts / 1_000 - 1).max() < 0.15


def test_odd_rows_and_files(spark, frame, scratch):
    made = frame(ODD, extra=True)
    _check(shard_digests(made).collect(), ODD, 40)
    assert shard_digests(frame([])).collect() == []
    placed = shuffled(made.withColumnRenamed("row", "shard"), 3)
    assert placed.columns == [*(c for c in made.columns if c != "row"), "shard", "slot"]
    write_shards(made, scratch, 3)
    back = spark.read.parquet(scratch)
    assert back.count() == len(ODD) and back.select("shard").distinct().count() == 3


def test_columns_of_any_name_stay(spark):
    rows = [(i, f"t{i}", i, i + 1, i + 2, i + 3, "d") for i in range(50)]
    names = ["doc_id", "text", "_at", "_row", "_bucket", "_base", "d"]
    made = spark.createDataFrame(rows, names)
    placed = shuffled(made, 4, bucket_bytes=200)
    assert placed.columns == [*names, "shard", "slot"]
    found = placed.collect()
    assert sorted(tuple(r)[:7] for r in found) == rows
    sizes = [sorted(r.slot for r in found if r.shard == s) for s in range(4)]
    assert all(s == list(range(len(s))) for s in sizes) and sum(map(len, sizes)) == 50


def test_starts_of_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(external_shuffle, "RUN_OF", 7)
    sizes = spark.range(100).where("id % 9 != 4").selectExpr("id AS bucket", "id % 5 + 1 AS n")
    found = {r.bucket: r.before for r in external_shuffle._starts(sizes).collect()}
    before = 0
    for bucket in range(100):
        if bucket % 9 != 4:
            assert found.pop(bucket) == before
            before += bucket % 5 + 1
    assert not found
