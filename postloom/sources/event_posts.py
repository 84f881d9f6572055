"""Posts, messages and envelopes derived from ``events`` and ``documents``.

Each event is one capture of a question. Its title is the whole text of the
document of the same number where there is one, and a line made of the event's
own columns otherwise, so both tables are read whole and joined one to one.
The number ``k`` in ``props`` decides which rows lack values or are faulty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.functions import json_quoted, post_json
from postloom.operators.pinning import pin
from postloom.sources.tables import base_table

BLANK_TITLE = " \t "
BLANK_LINE = " \t"
NOT_BASE64 = "!not base64!"


def _numbered(events: DataFrame) -> DataFrame:
    """Events with the number ``k`` of their ``props``."""
    return pin(events, "k", F.get_json_object("props", "$.k").cast("int"))


def _events(spark: SparkSession, root: str) -> DataFrame:
    return _numbered(base_table(spark, root, "events"))


def _unless(k: int, value: Column) -> Column:
    """The value, missing where ``k`` has the given number."""
    return F.when(F.col("k") != k, value)


def _owner() -> Column:
    user = F.col("user_id")
    return F.struct(
        (user + 1000000).alias("account_id"),
        user.alias("user_id"),
        (user % 1000).cast("int").alias("reputation"),
        F.lit("registered").alias("user_type"),
        _unless(71, F.concat(F.lit("User#"), user)).alias("display_name"),
        F.lit(None).cast("string").alias("profile_image"),
        F.concat(F.lit("https://example.org/u/"), user).alias("link"),
    )


def _question_id() -> Column:
    """From k = 90 on, a capture of one of the ten questions before it."""
    event, back = F.col("event_id"), F.col("k") - 89
    return F.when((F.col("k") >= 90) & (event >= back), event - back).otherwise(event)


def captures(spark: SparkSession, root: str) -> DataFrame:
    """Posts without titles: the ``events`` table alone."""
    return _captured(_events(spark, root))


def _captured(events: DataFrame, *others: str) -> DataFrame:
    """Captures of numbered events, with other columns that the events have."""
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    return events.select(
        F.col("event_id").alias("seq"),
        F.unix_date(F.col("ts").cast("date")).cast("bigint").alias("batch_id"),
        F.concat(F.lit("m"), "event_id").alias("message_id"),
        F.col("ts").cast("timestamp").alias("publish_ts"),
        "k",
        _question_id().alias("question_id"),
        F.concat(
            "event_type", F.lit(" «"), "props", F.lit("» déjà-vu nº "), "event_id"
        ).alias("own_title"),
        F.concat(F.lit("https://example.org/q/"), _question_id()).alias("link"),
        _unless(23, F.floor("value").cast("int") - 20).alias("score"),
        _unless(17, (F.col("user_id") % 15).cast("int")).alias("answer_count"),
        F.floor(F.col("value") * 10).cast("int").alias("view_count"),
        (F.col("event_type") == "purchase").alias("is_answered"),
        _unless(53, seconds).alias("creation_date"),
        (seconds + F.floor(F.col("value") * 1000)).alias("last_activity_date"),
        F.array("event_type", F.concat(F.lit("k"), F.col("k"))).alias("tags"),
        _unless(31, F.lit("CC BY-SA 4.0")).alias("content_license"),
        _unless(29, _owner()).alias("owner"),
        *others,
    )


def posts(spark: SparkSession, root: str) -> DataFrame:
    """Posts with titles: one document at most for each capture.

    The size estimate of a text column is a fixed few bytes a row, far below
    the truth, so the join is told to merge and never broadcasts the texts. Captures are
    worked out after it: the events' own columns are a fraction of theirs to shuffle.
    """
    texts = base_table(spark, root, "documents").select("doc_id", "text").hint("merge")
    events = base_table(spark, root, "events")
    both = events.join(texts, F.col("event_id") == F.col("doc_id"), "left")
    joined = _captured(_numbered(both), "text")
    title = (
        F.when(F.col("k") == 37, None)
        .when(F.col("k") == 41, BLANK_TITLE)
        .otherwise(F.coalesce("text", "own_title"))
    )
    return joined.withColumn("title", title).drop("own_title", "text")


def _fragment(name: str, good: Column, faults: dict[int, str]) -> Column:
    """``"name":value,`` with JSON texts put in for the faulty numbers."""
    value = F.coalesce(good, F.lit("null"))
    for k, text in faults.items():
        value = F.when(F.col("k") == k, text).otherwise(value)
    return F.concat(F.lit(f'"{name}":'), value, F.lit(","))


def messages(spark: SparkSession, root: str) -> DataFrame:
    """One raw JSON text per capture; some are faulty, some lines are blank."""
    source = posts(spark, root)

    def plain(name: str) -> Column:
        return F.col(name).cast("string")

    record = F.concat(
        F.lit("{"),
        F.when(F.col("k") == 2, "").otherwise(
            _fragment(
                "question_id",
                plain("question_id"),
                {3: "null", 15: '"7"', 19: "99999999999999999999"},
            )
        ),
        _fragment("title", json_quoted(F.col("title")), {8: "5"}),
        _fragment("link", json_quoted(F.col("link")), {}),
        _fragment("score", plain("score"), {4: "3000000000", 5: '"x"', 10: "5.5"}),
        _fragment("answer_count", plain("answer_count"), {}),
        _fragment("view_count", plain("view_count"), {16: "true"}),
        _fragment("is_answered", plain("is_answered"), {14: '"yes"'}),
        _fragment("creation_date", plain("creation_date"), {}),
        _fragment("last_activity_date", plain("last_activity_date"), {}),
        _fragment("tags", F.to_json("tags"), {6: "[1]", 7: '["a",null]', 18: "[]"}),
        _fragment("content_license", json_quoted(F.col("content_license")), {}),
        _fragment("owner", post_json(F.col("owner")), {9: "{}", 13: '"x"'}),
        F.lit('"accepted_answer_id":'),
        F.col("seq"),
        F.lit("}"),
    )
    value = (
        F.when(F.col("k") == 1, "not json")
        .when(F.col("k") == 11, BLANK_LINE)
        .when(F.col("k") == 12, "[1, 2]")
        .otherwise(record)
    )
    return pin(source, "value", value).select(
        "seq",
        "message_id",
        "publish_ts",
        "k",
        "value",
        F.create_map(F.lit("key"), F.col("tags")[0]).alias("attributes"),
    )


def envelopes(spark: SparkSession, root: str) -> DataFrame:
    """The messages as push envelopes, some of them faulty."""

    def around(data: Column) -> Column:
        return F.concat(
            F.lit('{"message":{"messageId":"'),
            "message_id",
            F.lit('","data":"'),
            data,
            F.lit('"}}'),
        )

    # Spark breaks long base64 text into lines; an envelope is a single one.
    # A replacement looks for whole breaks, where a translation looks up every character.
    encoded = F.replace(F.base64(F.col("value").cast("binary")), F.lit("\r\n"), F.lit(""))
    k = F.col("k")
    envelope = (
        F.when(k == 60, "not json")
        .when(k == 61, "{}")
        .when(k == 62, '{"subscription":"s"}')
        .when(
            k == 63, F.concat(F.lit('{"message":{"messageId":"'), "message_id", F.lit('"}}'))
        )
        .when(k == 64, around(F.lit("")))
        .when(k == 65, around(F.lit(NOT_BASE64)))
        .otherwise(around(encoded))
    )
    return messages(spark, root).select("seq", "publish_ts", envelope.alias("value"))


def keyed_lines(spark: SparkSession, root: str) -> DataFrame:
    """``key:value`` lines, one per event; a few lack the separator."""
    events = _events(spark, root)
    text = F.concat(F.lit("Message "), "event_id", F.lit(" from "), "props")
    line = F.when(F.col("k") == 61, "no separator here").otherwise(
        F.concat("event_type", F.lit(":"), text)
    )
    return events.select(F.col("event_id").alias("seq"), line.alias("line"))
