"""Envelopes, file topics, keys and subscriptions."""

from __future__ import annotations

import base64
import datetime
import json
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from postloom.functions import payload_length, payload_preview, title_preview
from postloom.operators import contract, messaging, ranking
from postloom.operators.envelope import open_envelopes
from postloom.sinks import files
from postloom.sources import topics


def envelope(data, message_id="7"):
    return json.dumps({"message": {"messageId": message_id, "data": data}})


@pytest.mark.parametrize(
    ("text", "status", "payload"),
    [
        ("not json", "no_message", None),
        ("{}", "no_message", None),
        ('{"message": null}', "no_message", None),
        ('{"message": {}}', "no_data", None),
        ('{"message": {"messageId": "7"}}', "no_data", None),
        (envelope(""), "no_data", None),
        (envelope("!!!!"), "ok", None),
        (envelope(base64.b64encode("é{}".encode()).decode()), "ok", "é{}".encode()),
    ],
)
def test_envelope(spark, text, status, payload):
    row = open_envelopes(spark.createDataFrame([(text,)], "value string")).first()
    assert (row["status"], row["payload"]) == (status, payload)


def test_payload_preview(spark):
    rows = spark.createDataFrame([(bytearray(range(250, 256)) + b"\x00" * 9,)], "b binary")
    row = rows.select(payload_length(F.col("b")), payload_preview(F.col("b"))).first()
    assert tuple(row) == (15, "fafbfcfdfeff00000000")


def test_title_preview(spark):
    rows = spark.createDataFrame([(None,), ("ü" * 100,)], "t string")
    found = [row[0] for row in rows.select(title_preview(F.col("t"))).collect()]
    assert found == ["<no title>", "ü" * 80]


def test_topic_skips_blank_lines(spark, scratch):
    lines = ['{"question_id":1,"tags":["a"]}', "", " \t ", " ", "\x1c", '{"title":"t"}']
    files.write_topic(spark.createDataFrame([(x,) for x in lines], "value string"), scratch)
    rows = topics.topic_posts(topics.read_topic(spark, scratch))
    assert {tuple(r) for r in rows.select("question_id", "title").collect()} == {
        (1, None),
        (None, "t"),
    }
    # Writing again replaces the topic.
    files.write_topic(spark.createDataFrame([("x",)], "value string"), scratch)
    assert topics.read_topic(spark, scratch).count() == 1


def test_topic_lines_that_cannot_be_read_have_a_reason(spark, scratch):
    lines = ["bad", "[1]", '{"question_id":1,"title":{"a":1}}', '{"question_id":2,"title":"t"}']
    files.write_topic(spark.createDataFrame([(x,) for x in lines], "value string"), scratch)
    found = topics.topic_posts(topics.read_topic(spark, scratch)).collect()
    assert {(r["question_id"], r["title"], r["error_reason"], r["raw"]) for r in found} == {
        (None, None, "bad_json", "bad"),
        (None, None, "not_object", "[1]"),
        (None, None, "bad_type: title", lines[2]),
        (2, "t", None, None),
    }


def test_kafka_headers_may_repeat(spark):
    schema = (
        "topic string, partition int, offset long, key binary, value binary, timestamp timestamp, "
        "headers array<struct<key: string, value: binary>>"
    )
    headers = [("a", b"1"), ("b", b"2"), ("a", b"3")]
    rows = [("t", 0, 5, None, b"v", None, headers), ("t", 0, 6, b"k", None, None, None)]
    found = topics.kafka_rows(spark.createDataFrame(rows, schema)).collect()
    assert [r["attributes"] for r in found] == [{"a": "3", "b": "2"}, {}]
    assert found[0]["message_id"] == "t-0-5"
    with pytest.raises(ValueError, match="earliest"):
        topics.kafka_messages(spark, "x:1", "t", streaming=False, starting="latest")


def test_dead_letters_as_messages_go_to_a_sink(spark):
    rows = spark.createDataFrame([("m1", "bad")], "message_id string, value string")
    letters = contract.dead_letters(contract.check_contract(rows), timestamp=F.lit("t"))
    row = files.to_kafka_rows(contract.dead_messages(letters)).first()
    assert row["value"] == "bad" and len(row["headers"]) == 4


def test_keyed_order_shuffles_rows_once(spark):
    rows = spark.range(100).selectExpr("id AS seq", "IF(id % 7 = 0, NULL, concat('k', id % 3)) AS key")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        ordered = messaging.keyed_order(rows, span=10)
        plan = ordered._jdf.queryExecution().executedPlan().toString()
        found = ordered.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    sides = plan.split("partial_count")
    assert len(exchanges) - (len(sides) - 1) * 3 <= 1, plan
    assert len(found) == 100
    for r in found:
        same = [o for o in found if o["partition"] == r["partition"]]
        assert r["offset"] == sum(o["seq"] < r["seq"] for o in same)
        assert r["key_position"] == sum(o["seq"] < r["seq"] and o["key"] == r["key"] for o in same)


def test_split_keyed(spark):
    lines = ["A:Message 1 from A", "B:x:y", ":empty key", "none", "C:"]
    rows = spark.createDataFrame([(x,) for x in lines], "line string")
    found = [(r["key"], r["value"]) for r in messaging.split_keyed(rows).collect()]
    assert found == [
        ("A", "Message 1 from A"),
        ("B", "x:y"),
        ("", "empty key"),
        (None, "none"),
        ("C", ""),
    ]


def test_positions_are_exact_across_blocks(spark):
    """A third of all rows has one key; blocks are far smaller than that."""
    keys = ["hot" if i % 3 == 0 else f"k{i % 50}" for i in range(900)]
    keys[10] = None
    rows = spark.createDataFrame(list(enumerate(keys)), "seq long, key string")
    found = messaging.keyed_order(rows, partitions=3, span=37).collect()
    assert len(found) == 900
    by_partition, by_key = defaultdict(list), defaultdict(list)
    for row in sorted(found, key=lambda r: r["seq"]):
        by_partition[row["partition"]].append(row["offset"])
        by_key[row["key"]].append((row["partition"], row["key_position"]))
    for offsets in by_partition.values():
        assert offsets == list(range(len(offsets)))
    for places in by_key.values():
        assert len({partition for partition, _ in places}) == 1
        assert [position for _, position in places] == list(range(len(places)))


def test_subscriptions(spark):
    start = datetime.datetime(2024, 1, 1)
    rows = spark.createDataFrame(
        [
            (f"m{i}", start + datetime.timedelta(days=i), {"key": key} if key else None)
            for i, key in enumerate(["A", "A", "B", "B", "C", None])
        ],
        "message_id string, publish_ts timestamp, attributes map<string,string>",
    )
    subscriptions = [
        messaging.Subscription("all"),
        messaging.Subscription("backup"),
        messaging.Subscription("late", created="2024-01-05 00:00:00"),
        messaging.Subscription("only-a", attributes={"key": "A"}),
    ]
    copies = defaultdict(set)
    for row in messaging.fan_out(rows, subscriptions).collect():
        copies[row["subscription"]].add(row["message_id"])
    everything = {f"m{i}" for i in range(6)}
    assert copies == {
        "all": everything,
        "backup": everything,
        "late": {"m4", "m5"},
        "only-a": {"m0", "m1"},
    }
    for subscription in subscriptions:
        alone = messaging.subscribe(rows, subscription).collect()
        assert {row["message_id"] for row in alone} == copies[subscription.name]


def test_top_posts(spark):
    rows = spark.createDataFrame(
        [(1, 5, 10, 3, ["x"]), (2, 9, 20, None, ["x", "y"]), (3, None, 30, 2, ["x"]),
         (4, 9, 40, 1, ["x"]), (5, 99, 50, 9, ["z"])],
        "question_id long, score int, last_activity_date long, creation_date long,"
        "tags array<string>",
    )

    def ids(**options):
        return [r["question_id"] for r in ranking.top_posts(rows, **options).collect()]

    assert ids(tagged="x") == [2, 4, 1, 3]
    assert ids(tagged="x", pagesize=2) == [2, 4]
    assert ids(sort="activity") == [5, 4, 3, 2, 1]
    assert ids(sort="creation", order="asc", tagged="x") == [2, 4, 3, 1]
    with pytest.raises(ValueError):
        ids(order="up")
    chosen = ranking.filter_posts(rows, min_votes=9, tagged="x").collect()
    assert {row["question_id"] for row in chosen} == {2, 4}
