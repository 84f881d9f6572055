"""Streams: results, restarts and redelivery."""

from __future__ import annotations

import base64
import datetime
import json
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from postloom.schema import STORED
from postloom.sinks import files
from postloom.sources import topics
from postloom.streaming import ingest


def envelope(number, record):
    data = base64.b64encode(json.dumps(record).encode()).decode()
    return json.dumps({"message": {"messageId": f"m{number}", "data": data}})


def add_lines(spark, path, lines):
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    df.coalesce(1).write.mode("append").text(path)


def ingested(spark, scratch):
    lines = topics.stream_topic(spark, f"{scratch}/topic", max_files=1)
    ingest.start_ingest(lines, f"{scratch}/out", f"{scratch}/checkpoint").awaitTermination()
    table = files.read_appended(spark, f"{scratch}/out/table", STORED)
    return sorted(row["question_id"] for row in table.collect())


def test_ingest_and_restart(spark, scratch):
    good = {"question_id": 1, "title": "é", "creation_date": 1763996420}
    add_lines(
        spark,
        f"{scratch}/topic",
        [
            envelope(1, good),
            "",
            envelope(2, {**good, "question_id": 2, "score": "x"}),
            envelope(3, {**good, "question_id": 3, "creation_date": None}),
            "{}",
            '{"message": {"messageId": "m5"}}',
            '{"message": {"messageId": "m6", "data": "!!!!"}}',
        ],
    )
    assert ingested(spark, scratch) == [1]
    # The same checkpoint again adds nothing; a new file adds its rows.
    assert ingested(spark, scratch) == [1]
    add_lines(spark, f"{scratch}/topic", [envelope(7, {**good, "question_id": 7})])
    assert ingested(spark, scratch) == [1, 7]

    archive = files.read_json_archive(spark, f"{scratch}/out/json").collect()
    assert {json.loads(row["json"])["question_id"] for row in archive} == {1, 7}
    hours = files.read_hour_partitions(spark, f"{scratch}/out/parquet", STORED).collect()
    assert {(r["question_id"], r["day"], r["hour"]) for r in hours} == {
        (1, "24", "15"),
        (7, "24", "15"),
    }
    letters = spark.read.parquet(f"{scratch}/out/dead_letters").collect()
    assert {(r["message_id"], r["failed_stage"], r["error_reason"]) for r in letters} == {
        ("m2", "contract", "bad_type: score"),
        ("m3", "partition", "no_creation_date"),
        (None, "envelope", "no_message"),
        ("m5", "envelope", "no_data"),
        ("m6", "decode", "bad_base64"),
    }


def test_batch_that_fails_is_run_again_once_only(spark, scratch):
    """The first attempt at a batch dies after its first store is written."""
    from postloom.plans.landing import land, receive, stored as kept

    good = {"question_id": 1, "creation_date": 0}
    second = {**good, "question_id": 2}
    add_lines(spark, f"{scratch}/topic", [envelope(1, good), envelope(2, second)])
    attempts = []

    def write(batch, own):
        attempts.append(own)
        files.write_json_archive(kept(receive(batch)), f"{scratch}/out/json", own)
        if len(attempts) == 1:
            raise RuntimeError("lost")
        land(receive(batch), f"{scratch}/out", own)

    for attempt in range(2):
        lines = topics.stream_topic(spark, f"{scratch}/topic", max_files=1)
        query = ingest.run_batches(lines, write, f"{scratch}/checkpoint")
        if attempt == 0:
            with pytest.raises(StreamingQueryException, match="lost"):
                query.awaitTermination()
        else:
            query.awaitTermination()
    assert len(attempts) == 2 and attempts[0] == attempts[1]
    assert files.read_json_archive(spark, f"{scratch}/out/json").count() == 2
    assert files.read_appended(spark, f"{scratch}/out/table", STORED).count() == 2


def test_a_second_checkpoint_destroys_nothing(spark, scratch):
    good = {"question_id": 1, "creation_date": 0}
    add_lines(spark, f"{scratch}/topic", [envelope(1, good)])
    assert ingested(spark, scratch) == [1]
    add_lines(spark, f"{scratch}/other", [envelope(2, {**good, "question_id": 2}), envelope(1, good)])
    lines = topics.stream_topic(spark, f"{scratch}/other", max_files=1)
    ingest.start_ingest(lines, f"{scratch}/out", f"{scratch}/second").awaitTermination()
    table = files.read_appended(spark, f"{scratch}/out/table", STORED)
    assert sorted(r["question_id"] for r in table.collect()) == [1, 1, 2]
    latest = files.latest_archive(spark, f"{scratch}/out/json").collect()
    assert sorted(r["message_id"] for r in latest) == ["m1", "m2"]


def test_times_out_of_range_do_not_stop_the_stream(spark, scratch):
    good = {"question_id": 1, "creation_date": 1763996420}
    odd = [{**good, "creation_date": t} for t in (10**18, 1704067200000, -(10**18))]
    add_lines(spark, f"{scratch}/topic", [envelope(i, r) for i, r in enumerate([good, *odd])])
    assert ingested(spark, scratch) == [1]
    letters = spark.read.parquet(f"{scratch}/out/dead_letters").collect()
    assert {(r["message_id"], r["failed_stage"], r["error_reason"]) for r in letters} == {
        (f"m{i}", "partition", "bad_creation_date") for i in (1, 2, 3)
    }


def test_routing(spark, scratch):
    add_lines(spark, f"{scratch}/topic", ['{"question_id": 1}', "bad", '{"question_id": null}'])
    for _ in range(2):
        lines = topics.stream_topic(spark, f"{scratch}/topic", 4).withColumn(
            "message_id", F.md5("value")
        )
        ingest.start_routing(lines, f"{scratch}/out", f"{scratch}/checkpoint").awaitTermination()
    written = spark.read.parquet(f"{scratch}/out")
    letters = ingest.routed_letters(written, timestamp=F.lit("t")).collect()
    assert {(r["raw"], r["error_reason"]) for r in letters} == {
        ("bad", "bad_json"),
        ('{"question_id": null}', "null_id"),
    }
    assert [r["post"]["question_id"] for r in ingest.routed_posts(written).collect()] == [1]


SCHEMA = "message_id string, publish_ts timestamp, value string"


def add_messages(spark, path, *numbers):
    start = datetime.datetime(2024, 1, 1)
    rows = [
        (f"m{n}", None if n is None else start + datetime.timedelta(days=n), f"v{n}")
        for n in numbers
    ]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_redelivery_within_the_watermark(spark, scratch):
    add_messages(spark, f"{scratch}/topic", 1, 2, 2, 3)
    add_messages(spark, f"{scratch}/topic", 3, 4, 1)
    stream = (
        spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{scratch}/topic")
    )
    once = ingest.drop_redelivered(stream, "10 days")
    for _ in range(2):
        (
            once.writeStream.format("parquet")
            .option("checkpointLocation", f"{scratch}/checkpoint")
            .trigger(availableNow=True)
            .start(f"{scratch}/out")
            .awaitTermination()
        )
    found = sorted(r["message_id"] for r in spark.read.parquet(f"{scratch}/out").collect())
    assert found == ["m1", "m2", "m3", "m4"]


def test_messages_without_an_id_all_stay(spark, scratch):
    rows = [(None, datetime.datetime(2024, 1, 1), f"v{i}") for i in range(3)]
    rows += [("m1", datetime.datetime(2024, 1, 1), "x")] * 2
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{scratch}/topic")

    def stream():
        return spark.readStream.schema(SCHEMA).parquet(f"{scratch}/topic")

    ingest.start_first_deliveries(stream(), f"{scratch}/out", f"{scratch}/c1").awaitTermination()
    once = ingest.drop_redelivered(stream(), "1 day").writeStream.format("parquet")
    once = once.option("checkpointLocation", f"{scratch}/c2").trigger(availableNow=True)
    once.start(f"{scratch}/once").awaitTermination()
    for path in ("out", "once"):
        found = [r["message_id"] for r in spark.read.parquet(f"{scratch}/{path}").collect()]
        assert sorted(map(str, found)) == ["None"] * 3 + ["m1"]


def test_first_deliveries_write_few_files(spark, scratch):
    rows = spark.range(1000).selectExpr(
        "concat('m', id) AS message_id",
        "timestamp_seconds(1704067200 + id % 30 * 86400) AS publish_ts",
        "'v' AS value",
    )
    rows.repartition(16).write.parquet(f"{scratch}/topic")
    stream = spark.readStream.schema(SCHEMA).parquet(f"{scratch}/topic")
    ingest.start_first_deliveries(stream, f"{scratch}/out", f"{scratch}/c").awaitTermination()
    written = sum(f.endswith(".parquet") for _, _, names in os.walk(f"{scratch}/out") for f in names)
    assert written <= 60


def test_first_deliveries_however_late(spark, scratch):
    def run():
        stream = (
            spark.readStream.schema(SCHEMA)
            .option("maxFilesPerTrigger", 1)
            .parquet(f"{scratch}/topic")
        )
        ingest.start_first_deliveries(
            stream, f"{scratch}/out", f"{scratch}/checkpoint"
        ).awaitTermination()
        rows = spark.read.parquet(f"{scratch}/out").collect()
        return sorted(r["message_id"] for r in rows)

    add_messages(spark, f"{scratch}/topic", 1, 200, 200)
    assert run() == ["m1", "m200"]
    # Redelivered long after, next to new and very old messages.
    add_messages(spark, f"{scratch}/topic", 200, 1, 0, 300, 300)
    assert run() == ["m0", "m1", "m200", "m300"]
    assert run() == ["m0", "m1", "m200", "m300"]
    add_messages(spark, f"{scratch}/topic", None, None, 1)
    assert run() == ["m0", "m1", "m200", "m300", "mNone"]
    add_messages(spark, f"{scratch}/topic", None)
    assert run() == ["m0", "m1", "m200", "m300", "mNone"]


def test_untimed_messages_are_listed_by_part(spark, scratch, monkeypatch):
    """A batch of one untimed message lists one of the parts that such messages fill."""
    listed, known = [], ingest._known_ids

    def listing(session, root, days, own):
        listed.append(days)
        return known(session, root, days, own)

    monkeypatch.setattr(ingest, "_known_ids", listing)

    def run(*ids):
        rows = spark.createDataFrame([(i, None, "v") for i in ids], SCHEMA)
        rows.coalesce(1).write.mode("append").parquet(f"{scratch}/topic")
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1)
        ingest.start_first_deliveries(
            stream.parquet(f"{scratch}/topic"), f"{scratch}/out", f"{scratch}/c"
        ).awaitTermination()
        return sorted(str(r["message_id"]) for r in spark.read.parquet(f"{scratch}/out").collect())

    ids = [f"m{n}" for n in range(40)]
    assert run(*ids) == sorted(ids)
    assert len(listed[0]) > 10
    assert run("m7", None) == sorted([*ids, "None"])
    assert len(listed[1]) == 1 and listed[1][0] in listed[0]
