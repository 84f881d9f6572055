"""Commits over several stores, numbered versions, and parts replaced one by one."""

from __future__ import annotations

import datetime
import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postloom.plans import landing
from postloom.plans.landing import land, receive
from postloom.sinks import commits, files, objects, parts, versions
from postloom.sources import topics
from postloom.streaming import ingest
from tests.test_streaming import add_lines, envelope

GOOD = {"question_id": 1, "title": "t", "creation_date": 1763996420}


def _start(spark, scratch):
    lines = topics.stream_topic(spark, f"{scratch}/topic", max_files=1)
    return ingest.start_committed_ingest(lines, f"{scratch}/out", f"{scratch}/checkpoint")


def _seen(spark, scratch):
    """Message ids by store."""
    return {
        store: sorted(
            str(r["message_id"])
            for r in commits.read_committed(spark, f"{scratch}/out", store).collect()
        )
        for store in commits.STORES
    }


def test_half_a_batch_is_never_seen(spark, scratch, monkeypatch):
    """The second batch dies between the second and the third store."""
    add_lines(spark, f"{scratch}/topic", [envelope(1, GOOD), "{}"])
    _start(spark, scratch).awaitTermination()
    before = _seen(spark, scratch)
    assert before == {"json": ["m1"], "parquet": ["m1"], "table": ["m1"], "dead_letters": ["None"]}

    add_lines(spark, f"{scratch}/topic", [envelope(2, {**GOOD, "question_id": 2})])
    append, calls = landing.append_table, []

    def failing(*args):
        calls.append(args)
        raise RuntimeError("lost")

    monkeypatch.setattr(landing, "append_table", failing)
    with pytest.raises(StreamingQueryException, match="lost"):
        _start(spark, scratch).awaitTermination()
    assert calls
    # Both finished stores hold the new rows, and no reader shows them.
    whole = files.read_json_archive(spark, f"{scratch}/out/json")
    assert sorted(r["message_id"] for r in whole.collect()) == ["m1", "m2"]
    assert _seen(spark, scratch) == before

    monkeypatch.setattr(landing, "append_table", append)
    _start(spark, scratch).awaitTermination()
    after = _seen(spark, scratch)
    assert after["json"] == after["parquet"] == after["table"] == ["m1", "m2"]
    rows = {r["batch"]: r.asDict() for r in commits.manifest(spark, f"{scratch}/out").collect()}
    assert [(rows[n]["stored"], rows[n]["refused"]) for n in (0, 1)] == [(1, 1), (1, 0)]


def test_committed_batch_is_not_written_again(spark, scratch):
    lines = spark.createDataFrame([(envelope(1, GOOD),)], "value string")
    batch = files.Batch("run", 0)
    assert commits.land_committed(receive(lines), f"{scratch}/out", batch)
    other = spark.createDataFrame([(envelope(2, GOOD),)], "value string")
    assert not commits.land_committed(receive(other), f"{scratch}/out", batch)
    assert _seen(spark, scratch)["table"] == ["m1"]


def test_batches_without_rows_and_stores_without_commits(spark, scratch):
    assert _seen(spark, scratch) == {store: [] for store in commits.STORES}
    land(receive(spark.createDataFrame([(envelope(1, GOOD),)], "value string")), f"{scratch}/out", files.Batch("x", 0))
    assert _seen(spark, scratch) == {store: [] for store in commits.STORES}
    for number, line in enumerate(["{}", envelope(3, GOOD)]):
        lines = spark.createDataFrame([(line,)], "value string")
        commits.land_committed(receive(lines), f"{scratch}/out", files.Batch("y", number))
    assert _seen(spark, scratch) == {
        "json": ["m3"], "parquet": ["m3"], "table": ["m3"], "dead_letters": ["None"]
    }


def test_manifest_is_one_small_join(spark, scratch):
    lines = spark.createDataFrame([(envelope(1, GOOD),)], "value string")
    for number in range(3):
        commits.land_committed(receive(lines), f"{scratch}/out", files.Batch("run", number))
    table = commits.read_committed(spark, f"{scratch}/out", "table")
    assert table.count() == 3
    plan = table._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [run") == 1 and "max(batch" in plan


def test_versions_count_up_whatever_the_clock_says(spark, scratch):
    def rows(n):
        return spark.createDataFrame([("d", n)], "day string, n int")

    with pytest.raises(FileNotFoundError):
        files.read_table(spark, scratch)
    files.replace_table(rows(1), scratch, "day", "n")
    files.replace_table(rows(2), scratch, "day", "n")
    # A writer that dies before it is done leaves the older version in place.
    lost = versions.claim_version(spark, scratch)
    rows(99).write.parquet(versions.version_folder(scratch, lost))
    assert files.read_table(spark, scratch).first()["n"] == 2
    files.replace_table(rows(3), scratch, "day", "n")
    assert versions.done_versions(spark, scratch) == [1, 2, 4]
    assert versions.drop_versions(spark, scratch, keep=1) == [1, 2, 3]
    assert files.read_table(spark, scratch).first()["n"] == 3
    files.replace_table(rows(4), scratch, "day", "n")
    assert files.read_table(spark, scratch).first()["n"] == 4
    with pytest.raises(ValueError, match="keep"):
        versions.drop_versions(spark, scratch, keep=0)


def test_two_writers_get_different_numbers(spark, scratch):
    claimed = [versions.claim_version(spark, scratch) for _ in range(3)]
    assert claimed == [1, 2, 3]
    assert versions.done_versions(spark, scratch) == []
    assert versions.failed_versions(spark, scratch) == claimed


SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType())])


def _rows(spark, *rows):
    return spark.createDataFrame(list(rows), "id long, v string, part string")


def _held(spark, root, names=None):
    return sorted((r["part"], r["id"], r["v"]) for r in parts.read_parts(spark, root, SCHEMA, names).collect())


def test_parts_are_replaced_alone(spark, scratch):
    assert _held(spark, scratch) == [] == _held(spark, scratch, ["a"])
    parts.replace_parts(_rows(spark, (1, "x", "a"), (2, "y", "b")), scratch, ["a", "b"], "id")
    parts.replace_parts(_rows(spark, (3, "z", "b")), scratch, ["b", "c"], "id")
    assert _held(spark, scratch) == [("a", 1, "x"), ("b", 3, "z")]
    one = parts.read_parts(spark, scratch, SCHEMA, ["b"])
    assert all("part=b/version=2" in f for f in one.inputFiles()) and one.inputFiles()
    # A part can become empty, and a write that dies is not seen.
    parts.replace_parts(_rows(spark), scratch, ["a"], "id")
    assert _held(spark, scratch) == [("b", 3, "z")]
    lost = versions.claim_version(spark, scratch)
    _rows(spark, (9, "lost", "b")).withColumn("version", F.lit(lost).cast("long")).write.mode(
        "append"
    ).partitionBy("part", "version").parquet(f"{scratch}/rows")
    assert _held(spark, scratch) == _held(spark, scratch, ["a", "b", "c"]) == [("b", 3, "z")]
    assert parts.drop_old_parts(spark, scratch) == 2
    parts.replace_parts(_rows(spark, (4, "w", "a")), scratch, ["a"], "id")
    assert _held(spark, scratch) == [("a", 4, "w"), ("b", 3, "z")]


def test_a_second_writer_is_found_out(spark, scratch, monkeypatch):
    parts.replace_parts(_rows(spark, (1, "x", "a")), scratch, ["a"], "id")
    claim = parts.claim_version

    def meanwhile(session, root):
        number = claim(session, root)
        versions.publish_version(session, root, claim(session, root))
        return number

    monkeypatch.setattr(parts, "claim_version", meanwhile)
    with pytest.raises(RuntimeError, match="another writer"):
        parts.replace_parts(_rows(spark, (2, "y", "a")), scratch, ["a"], "id")


POSTS = "question_id long, creation_date long, score int, landed_at timestamp, position long"
FIRST = 1763996420


def _posts(spark, *rows):
    at = datetime.datetime(2025, 1, 1)
    full = [(q, t, s, at + datetime.timedelta(seconds=n), 0) for q, t, s, n in rows]
    return spark.createDataFrame(full, POSTS)


def test_objects_are_merged_by_hour(spark, scratch):
    hour, root = 3600, f"{scratch}/objects"
    schema = T._parse_datatype_string(POSTS)

    def held():
        rows = objects.read_objects(spark, root, schema).collect()
        return sorted((r["part"], r["question_id"], r["score"]) for r in rows)

    assert objects.upsert_objects(_posts(spark), root) == []
    first = _posts(spark, (1, FIRST, 10, 1), (1, FIRST + 60, 11, 2), (2, FIRST + hour, 20, 3))
    assert objects.upsert_objects(first, root) == ["2025-11-24-15", "2025-11-24-16"]
    assert held() == [("2025-11-24-15", 1, 11), ("2025-11-24-16", 2, 20)]
    # An older delivery that comes late does not win; the other hour is not touched.
    late = _posts(spark, (1, FIRST, 9, 0), (3, FIRST, 30, 4), (None, FIRST, 1, 9), (4, None, 1, 9))
    for _ in range(2):
        assert objects.upsert_objects(late, root) == ["2025-11-24-15"]
        assert held() == [("2025-11-24-15", 1, 11), ("2025-11-24-15", 3, 30), ("2025-11-24-16", 2, 20)]
    untouched = objects.read_objects(spark, root, schema, ["2025-11-24-16"])
    assert all("version=1" in f for f in untouched.inputFiles()) and untouched.inputFiles()


def test_json_archive_keeps_text(spark, scratch):
    lines = spark.createDataFrame([(envelope(1, {**GOOD, "title": "é«»"}),)], "value string")
    commits.land_committed(receive(lines), f"{scratch}/out", files.Batch("run", 0))
    (row,) = commits.read_committed(spark, f"{scratch}/out", "json").collect()
    assert json.loads(row["json"])["title"] == "é«»"
