"""What the registered streams leave on disk, and what they hold while they run."""

from __future__ import annotations

import datetime
import json
import os
import time

from pyspark.sql import functions as F

from postloom.plans import landing
from postloom.queries import spark_queries
from postloom.sinks import files
from postloom.sources import event_posts, topics
from postloom.streaming import ingest
from tests.test_streaming import add_lines, envelope

START = datetime.datetime(2024, 1, 15, 8)


def _tables(spark, root):
    """Thirty events, of which k 1, 2 and 60 to 64 are faulty somewhere, and a document."""
    events = [
        (i, START, i, "click", 1.0, json.dumps({"k": i if i < 3 else i + 40})) for i in range(30)
    ]
    names = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
    spark.createDataFrame(events, names).write.parquet(f"{root}/events.parquet")
    spark.createDataFrame([(5, "text é")], "doc_id long, text string").write.parquet(
        f"{root}/documents.parquet"
    )


def _names(root, folder=""):
    return [
        name
        for where, _, names in os.walk(root)
        for name in names
        if folder in where and name.startswith("part-")
    ]


def _run(spark, scratch, monkeypatch, name):
    """The rows of a query whose topic has several small files, and its own folder."""
    _tables(spark, f"{scratch}-in")
    monkeypatch.setattr(spark_queries, "scratch_path", lambda spark, label: scratch)
    monkeypatch.setattr(files, "PACKED_ROWS", 4)
    monkeypatch.setattr(spark_queries, "TOPIC_FILES", 2)
    return spark_queries.REGISTRY[name](spark, f"{scratch}-in").collect()


def _stores(rows):
    """Message ids by store."""
    found = {}
    for row in rows:
        found.setdefault(row["store"], []).append(str(row["message_id"]))
    return {store: sorted(ids) for store, ids in found.items()}


def _expected():
    """Of the events: those stored, and those refused by their id where the envelope has one."""
    ks = {i: i if i < 3 else i + 40 for i in range(30)}
    faulty = {1, 53, 60, 61, 62, 63, 64, 65}
    good = sorted(f"m{i}" for i, k in ks.items() if k not in faulty)
    letters = sorted(
        "None" if k in (60, 61, 62) else f"m{i}" for i, k in ks.items() if k in faulty
    )
    return good, letters


def test_lost_batches_are_bounded(spark, scratch, monkeypatch):
    """the lost run held the whole topic in one cache; stores and topic lay unpacked."""
    lost, append = [], files.append_table

    def counted(rows, root, own):
        lost.append((own, rows.count()))
        append(rows, root, own)

    monkeypatch.setattr(spark_queries.files, "append_table", counted)
    found = _stores(_run(spark, scratch, monkeypatch, "stream_ingest_committed"))
    good, letters = _expected()
    assert found == {"json": good, "parquet": good, "table": good, "dead_letters": letters}
    assert [own for own, _ in lost] == [files.Batch("lost", n) for n in range(len(lost))]
    assert len(lost) > 1 and sum(rows for _, rows in lost) == len(good)
    assert max(rows for _, rows in lost) <= 8
    assert all(name.endswith(".gz") for name in _names(scratch, "/json"))
    assert all(".zstd." in name for name in _names(scratch, "/table"))


def test_ingest_packs_what_it_stores(spark, scratch, monkeypatch):
    """topic, archive and letters lay on disk as plain text or nearly so."""
    found = _stores(_run(spark, scratch, monkeypatch, "stream_ingest"))
    good, letters = _expected()
    assert found == {"json": good, "parquet": good, "table": good, "dead_letters": letters}
    assert _names(scratch, "/json") and all(n.endswith(".gz") for n in _names(scratch, "/json"))
    for store in ("/out/parquet", "/table", "/dead_letters"):
        assert _names(scratch, store) and all(".zstd." in n for n in _names(scratch, store))
    # At most the files of the last batch may be left, and packed ones.
    left = _names(scratch, "/topic")
    assert len(left) <= 2 and all(name.endswith(".txt.gz") for name in left)


def test_archive_is_packed(spark, scratch, monkeypatch):
    """both archives of the topic and the topic itself lay on disk as plain text."""
    rows = _run(spark, scratch, monkeypatch, "stream_archive_latest")
    good, _ = _expected()
    assert sorted(r["message_id"] for r in rows) == good
    titles = {r["message_id"]: json.loads(r["json"])["title"] for r in rows}
    assert titles["m5"] == "text é" and "older" not in titles.values()
    assert _names(scratch, "/json") and all(n.endswith(".gz") for n in _names(scratch, "/json"))
    assert len(_names(scratch, "/topic")) <= 2


def _shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return blocks.getAllFiles().mkString(" ").count("/shuffle_")


def test_batches_leave_no_shuffle_files(spark, scratch):
    """shuffle files of all batches stayed until the driver's heap was collected."""
    good = {"question_id": 1, "title": "t", "creation_date": 1763996420}
    for i in range(3):
        add_lines(spark, f"{scratch}/topic", [envelope(i, {**good, "question_id": i})])
    before = _shuffle_files(spark)
    lines = topics.stream_topic(spark, f"{scratch}/topic", max_files=1)
    ingest.start_ingest(lines, f"{scratch}/out", f"{scratch}/checkpoint").awaitTermination()
    until = time.time() + 20
    while _shuffle_files(spark) > before and time.time() < until:
        time.sleep(0.2)
    assert _shuffle_files(spark) <= before


def test_cached_posts_come_back_whole(spark):
    """a cache held the text of every message, and posts as the bytes of their rows."""
    owner = {"account_id": 1, "link": "é"}
    records = [
        {"question_id": 1, "title": "é", "tags": ["a", ""], "creation_date": 0, "owner": owner},
        {"question_id": 2, "title": None, "tags": [], "creation_date": 0, "is_answered": True},
        {"creation_date": 0, "owner": {}, "score": -5},
        {"question_id": 3, "creation_date": 0, "owner": {"link": None}},
        {"question_id": 4, "score": "x"},
    ]
    lines = spark.createDataFrame(
        [(envelope(i, r),) for i, r in enumerate(records)] + [("{}",)], "value string"
    ).coalesce(1)
    received = landing.without_spent_text(landing.receive(lines)).drop("landed_at")
    flat = landing.flattened(received)
    assert not any(kind.startswith("struct") for _, kind in flat.dtypes)
    back = landing.unflattened(flat).select(*received.columns)
    assert back.dtypes == received.dtypes
    order = F.col("position")
    found = back.orderBy(order).collect()
    assert found == received.orderBy(order).collect()
    assert [r["raw"] is None for r in found] == [True, True, True, True, False, False]
    assert found[3]["post"]["owner"] is not None and found[2]["post"]["owner"] is None


def test_posts_shuffle_events_as_they_are(spark, scratch):
    """captures were worked out before the join, and shuffled four times as wide."""
    _tables(spark, scratch)
    plan = event_posts.posts(spark, scratch)._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Join LeftOuter")
    assert "example.org" in above and "example.org" not in below


def test_topic_gives_up_what_was_acknowledged(spark, scratch):
    """a topic lay on disk beside all that was made of it."""
    for i in range(4):
        add_lines(spark, f"{scratch}/topic", [f"line {i}"])
    kept = topics.stream_topic(spark, f"{scratch}/topic", max_files=1)
    seen = []

    def note(batch, own):
        seen.extend(row["value"] for row in batch.collect())

    ingest.run_batches(kept, note, f"{scratch}/first").awaitTermination()
    assert len(seen) == 4 and len(_names(scratch, "/topic")) == 4
    gone = topics.stream_topic(spark, f"{scratch}/topic", max_files=1, acknowledge=True)
    ingest.run_batches(gone, note, f"{scratch}/second").awaitTermination()
    assert sorted(seen) == sorted([f"line {i}" for i in range(4)] * 2)
    until = time.time() + 20
    while len(_names(scratch, "/topic")) > 1 and time.time() < until:
        time.sleep(0.2)
    assert len(_names(scratch, "/topic")) <= 1
