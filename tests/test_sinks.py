"""Landing formats and what they read back."""

from __future__ import annotations

import datetime
import json
import os

import pytest
from pyspark.sql import functions as F

from postloom.functions import epoch_day, hour_path, object_path, utc_now
from postloom.functions.timekeys import utc_text
from postloom.operators import contract, newest
from postloom.sinks import files
from postloom.sources.tables import latest_batch


def test_hour_paths(spark):
    rows = spark.createDataFrame(
        [(1763996420, 42), (1763996420, 123456789), (None, 1)], "t long, q long"
    )
    found = [r[0] for r in rows.select(object_path(F.col("t"), F.col("q"))).collect()]
    folder = "year=2025/month=11/day=24/hour=15"
    assert found == [f"{folder}/part-00000042.parquet", f"{folder}/part-123456789.parquet", None]


def test_hour_partitions_keep_zeros_and_prune(spark, scratch):
    rows = spark.createDataFrame(
        [(1, 1704067200), (2, 1704070800), (3, 1763996420)], "question_id long, creation_date long"
    )
    files.write_hour_partitions(rows, scratch)
    back = files.read_hour_partitions(spark, scratch, rows.schema)
    assert {tuple(r) for r in back.collect()} == {
        (1, 1704067200, "2024", "01", "01", "00"),
        (2, 1704070800, "2024", "01", "01", "01"),
        (3, 1763996420, "2025", "11", "24", "15"),
    }
    assert os.path.isdir(f"{scratch}/year=2024/month=01/day=01/hour=00")
    pruned = back.filter("year = '2025' AND month = '11'")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert pruned.count() == 1


def test_batch_written_again_replaces_itself(spark, scratch):
    rows = spark.createDataFrame([(1, 0), (2, 0)], "question_id long, creation_date long")
    for _ in range(2):
        files.write_hour_partitions(rows, scratch, files.Batch("a", 3))
        files.append_table(rows, f"{scratch}-table", files.Batch("a", 3))
    files.append_table(rows, f"{scratch}-table", files.Batch("a", 4))
    # Another checkpoint counts its batches from the start again.
    files.append_table(rows, f"{scratch}-table", files.Batch("b", 3))
    files.write_hour_partitions(rows, scratch, files.Batch("b", 3))
    assert files.read_hour_partitions(spark, scratch, rows.schema).count() == 4
    assert files.read_appended(spark, f"{scratch}-table", rows.schema).count() == 6
    assert os.path.isdir(f"{scratch}/year=1970/month=01/day=01/hour=00/run=a/batch=3")


def test_last_delivery_and_compaction(spark, scratch):
    schema = "message_id string, question_id long, creation_date long, landed_at timestamp, position long"
    early, late = datetime.datetime(2024, 1, 1), datetime.datetime(2024, 1, 2)
    rows = [("m1", 5, 0, early, 1), ("m2", 5, 60, early, 2), (None, 6, 0, early, 3)]
    again = [("m1", 5, 0, late, 0), (None, 6, 0, late, 1)]
    for run, part in (("a", rows), ("b", again)):
        frame = spark.createDataFrame(part, schema)
        files.write_hour_partitions(frame, f"{scratch}/hours", files.Batch(run, 0))
        post = frame.select("message_id", F.struct("question_id").alias("post"), "landed_at", "position")
        files.write_json_archive(post, f"{scratch}/json", files.Batch(run, 0))
    latest = files.latest_objects(spark, f"{scratch}/hours", frame.schema).collect()
    assert {(r["message_id"], r["question_id"], r["landed_at"]) for r in latest} == {
        ("m1", 5, late), (None, 6, late)
    }
    archive = files.latest_archive(spark, f"{scratch}/json").collect()
    assert sorted(str(r["message_id"]) for r in archive) == ["None", "None", "m1", "m2"]
    files.compact_hours(spark, f"{scratch}/hours", f"{scratch}/compact", frame.schema)
    assert files.read_hour_partitions(spark, f"{scratch}/compact", frame.schema).count() == 5
    folder = f"{scratch}/compact/year=1970/month=01/day=01/hour=00"
    assert len([f for f in os.listdir(folder) if f.endswith(".parquet")]) == 1


def test_results_of_a_repeated_run_replace_themselves(spark, scratch):
    rows = spark.createDataFrame([("r1", "t", 1.0), ("r2", "t", 2.0)], "run_id string, table_name string, observed double")
    files.store_results(rows, scratch)
    files.store_results(rows.filter("run_id = 'r1'"), scratch)
    files.store_results(rows.filter("run_id = 'r1'").withColumn("table_name", F.lit("u")), scratch)
    assert spark.read.parquet(scratch).count() == 3


def test_times_do_not_depend_on_the_zone(spark, scratch):
    rows = spark.createDataFrame([(1704070800,), (-1,), (10**18,), (1704070800000,), (None,)], "t long")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        found = rows.select(hour_path(F.col("t")), epoch_day(F.col("t")).cast("string")).collect()
        now = spark.range(1).select(utc_now()).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert [tuple(r) for r in found] == [
        ("year=2024/month=01/day=01/hour=01", "2024-01-01"),
        ("year=1969/month=12/day=31/hour=23", "1969-12-31"),
        (None, None),
        (None, None),
        (None, None),
    ]
    apart = datetime.datetime.fromisoformat(now) - datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)
    assert abs(apart.total_seconds()) < 60


def test_json_archive_keeps_nulls_and_letters(spark, scratch):
    text = '{"question_id": 7, "title": "Zürich \\"q\\" \\u00e9", "owner": {"user_id": 1}}'
    rows = spark.createDataFrame([("m1", text)], "message_id string, value string")
    files.write_json_archive(contract.valid_posts(contract.check_contract(rows)), scratch)
    row = files.read_json_archive(spark, scratch).first()
    record = json.loads(row["json"])
    assert row["message_id"] == "m1"
    assert record["title"] == 'Zürich "q" é' and "Zürich" in row["json"]
    assert record["score"] is None and record["owner"]["link"] is None


def test_latest_object(spark):
    rows = spark.createDataFrame(
        [(1, 5, 0), (2, 5, 60), (3, 5, 3600), (4, 6, 0)], "seq long, question_id long, t long"
    )
    kept = newest.latest_object(rows, hour_path(F.col("t")))
    assert {row["seq"] for row in kept.collect()} == {2, 3, 4}


def test_append_with_a_new_field(spark, scratch):
    old = spark.createDataFrame([(1,)], "question_id long")
    new = spark.createDataFrame([(2, "x")], "question_id long, license string")
    files.append_table(old, scratch)
    files.append_table(new, scratch)
    expected = {(1, None), (2, "x")}
    assert set(map(tuple, files.read_appended(spark, scratch).collect())) == expected
    given = files.read_appended(spark, scratch, new.schema)
    assert set(map(tuple, given.collect())) == expected


def test_replace_table_refreshes_and_prunes(spark, scratch):
    for n in (5, 3):
        rows = spark.range(n).select(
            F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("day"),
            F.lit("NEUTRAL").alias("sentiment"),
        )
        files.replace_table(rows, scratch, "day", "sentiment")
    back = files.read_table(spark, scratch)
    assert back.count() == 3
    broken = rows.withColumn("sentiment", F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(Exception, match="stop"):
        files.replace_table(broken, scratch, "day", "sentiment")
    assert files.read_table(spark, scratch).count() == 3
    chosen = back.filter("day = date'2024-01-02' AND sentiment = 'NEUTRAL'")
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    assert "EqualTo(sentiment,NEUTRAL)" in plan
    assert chosen.count() == 1


def test_routed_write_reads_one_route(spark, scratch):
    rows = spark.createDataFrame(
        [("m1", '{"question_id": 1}'), ("m2", "bad")], "message_id string, value string"
    )
    files.write_routed(contract.routed(contract.check_contract(rows)), scratch)
    dead = spark.read.parquet(scratch).filter("route = 'dead'")
    assert [r["message_id"] for r in dead.collect()] == ["m2"]
    plan = dead._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(route" in plan


def test_kafka_rows(spark):
    rows = spark.createDataFrame(
        [("1", "{}", {"source": "s"})], "key string, value string, attributes map<string,string>"
    )
    row = files.to_kafka_rows(rows).first()
    assert row["headers"][0]["key"] == "source" and bytes(row["headers"][0]["value"]) == b"s"


def test_latest_batch(spark):
    rows = spark.createDataFrame([(1, 10), (2, 20), (3, 20)], "seq long, batch_id long")
    assert {r["seq"] for r in latest_batch(rows).collect()} == {2, 3}


def test_utc_text_in_skipped_hours(spark):
    """New York skips 02:00 to 03:00 on 2024-03-10, and repeats an hour in November."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        micros = [1710037800000001, 1710039600000000, 1730611800000000, -1, 0]
        rows = spark.createDataFrame([(m,) for m in micros], "m long")
        found = [r[0] for r in rows.select(utc_text(F.col("m"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert found == [
        "2024-03-10T02:30:00.000001",
        "2024-03-10T03:00:00.000000",
        "2024-11-03T05:30:00.000000",
        "1969-12-31T23:59:59.999999",
        "1970-01-01T00:00:00.000000",
    ]
