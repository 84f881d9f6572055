"""Streams of subscriptions: their own progress, failure and start time."""

from __future__ import annotations

import datetime

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import types as T

from postloom.operators.messaging import Subscription, subscribe
from postloom.streaming import subscriptions as subs

SCHEMA = T.StructType(
    [
        T.StructField("message_id", T.StringType()),
        T.StructField("publish_ts", T.TimestampType()),
        T.StructField("value", T.StringType()),
        T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
    ]
)
START = datetime.datetime(2024, 1, 10, tzinfo=datetime.timezone.utc)


def _add(spark, path, *messages):
    rows = [
        (f"m{n}", None if day is None else START + datetime.timedelta(days=day), f"v{n}", {"key": key})
        for n, day, key in messages
    ]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def _stream(spark, path):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


def _held(spark, path):
    return sorted(r["message_id"] for r in spark.read.schema(SCHEMA).parquet(path).collect())


ALL = [
    Subscription("all"),
    Subscription("only-a", attributes={"key": "A"}),
    Subscription("later", created="2024-01-10T00:00:00"),
]


def test_one_subscription_fails_and_resumes_alone(spark, scratch):
    _add(spark, f"{scratch}/topic", (1, -1, "A"), (2, 0, "B"))
    _add(spark, f"{scratch}/topic", (3, 1, "A"), (4, None, "C"))
    seen = []

    def failing(rows, own):
        seen.append(own.number)
        if own.number == 1 and len(seen) == 2:
            raise RuntimeError("lost")
        subs._store(f"{scratch}/out/only-a")(rows, own)

    def start():
        return subs.start_fan_out(
            _stream(spark, f"{scratch}/topic"), ALL, f"{scratch}/out", f"{scratch}/checkpoints",
            {"only-a": failing},
        )

    queries = start()
    with pytest.raises(StreamingQueryException, match="lost"):
        queries["only-a"].awaitTermination()
    queries["all"].awaitTermination()
    queries["later"].awaitTermination()
    assert _held(spark, f"{scratch}/out/all") == ["m1", "m2", "m3", "m4"]
    assert _held(spark, f"{scratch}/out/later") == ["m2", "m3"]
    assert len(_held(spark, f"{scratch}/out/only-a")) == 1
    _add(spark, f"{scratch}/topic", (5, 2, "A"))
    for query in start().values():
        query.awaitTermination()
    assert _held(spark, f"{scratch}/out/only-a") == ["m1", "m3", "m5"]
    assert _held(spark, f"{scratch}/out/all") == ["m1", "m2", "m3", "m4", "m5"]
    assert seen == [0, 1, 1, 2]


def test_names_must_differ(spark, scratch):
    with pytest.raises(ValueError, match="names"):
        subs.start_fan_out(None, [Subscription("x"), Subscription("x")], scratch, scratch)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kathmandu"])
def test_start_is_a_moment_in_any_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = spark.sql(
            "SELECT explode(array(timestamp_seconds(1704844799), timestamp_seconds(1704844800),"
            " CAST(NULL AS TIMESTAMP))) AS publish_ts, CAST(map() AS map<string,string>) AS attributes"
        )
        for text in ("2024-01-10 00:00:00", "2024-01-10T01:00:00+01:00"):
            found = subscribe(rows, Subscription("s", created=text))
            assert [r[0] for r in found.selectExpr("unix_seconds(publish_ts)").collect()] == [1704844800]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_older_files_are_not_opened(spark, scratch, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    topic, index = f"{scratch}/topic", f"{scratch}/index"
    try:
        _add(spark, topic, (1, -3, "A"), (2, -2, "B"))
        _add(spark, topic, (3, -1, "A"), (4, 0, "B"), (5, None, "B"))
        subs.index_topic(spark, topic, SCHEMA, index)
        _add(spark, topic, (6, None, "A"))
        subs.index_topic(spark, topic, SCHEMA, index)
        opened = []

        def write(rows, own):
            opened.append(len(rows.inputFiles()))
            subs._store(f"{scratch}/out")(rows, own)

        def run():
            query = subs.start_from_time(
                spark, index, SCHEMA, ALL[2], f"{scratch}/out", f"{scratch}/c", write=write
            )
            query.awaitTermination()

        run()
        assert _held(spark, f"{scratch}/out") == ["m4"]
        # Of three files only the one that reaches the start.
        assert sum(opened) == 1
        _add(spark, topic, (7, 4, "A"))
        subs.index_topic(spark, topic, SCHEMA, index)
        subs.index_topic(spark, topic, SCHEMA, index)
        run()
        assert _held(spark, f"{scratch}/out") == ["m4", "m7"]
        assert sum(opened) == 2
        listed = spark.read.parquet(index).collect()
        assert sorted(r["messages"] for r in listed) == [1, 1, 2, 3]
        assert sorted(r["untimed"] for r in listed) == [0, 0, 1, 1]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
