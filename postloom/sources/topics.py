"""Message topics: folders of text lines, or Kafka where its connector is.

All sources yield frames that have at least ``value``; the Kafka source adds
``key``, ``attributes``, ``publish_ts`` and ``seq``.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.functions import not_blank_line
from postloom.operators.contract import check_contract, error_reason


def read_topic(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All lines of a topic folder, or of some of its files, blank ones left out."""
    return spark.read.text(path).filter(not_blank_line(F.col("value")))


def topic_files(spark: SparkSession, path: str) -> list[str]:
    """The files of a topic folder; one short name a file comes to the driver."""
    return [unquote(name) for name in sorted(spark.read.text(path).inputFiles())]


def stream_topic(
    spark: SparkSession, path: str, max_files: int, acknowledge: bool = False
) -> DataFrame:
    """The same as a stream; ``max_files`` bounds each micro-batch.

    With ``acknowledge`` the topic gives up a file once its batch is done, as a broker
    gives up acknowledged messages: no other stream must want it. Files of the last batch
    may stay.
    """
    reader = spark.readStream.format("text").option("maxFilesPerTrigger", max_files)
    if acknowledge:
        reader = reader.option("cleanSource", "delete")
    return reader.load(path).filter(not_blank_line(F.col("value")))


def topic_posts(
    lines: DataFrame, fields: list[str] | None = None, value: str = "value"
) -> DataFrame:
    """Some fields of every message, as a consumer prints them, and ``error_reason``.

    Lines that cannot be read as a post have null fields, the reason, and their
    text as ``raw``; for others both are null. A missing ``question_id`` is null.
    """
    checked = check_contract(lines, value, missing_id="reject")
    fields = fields or ["question_id", "title", "score", "tags", "link"]
    no_id = (F.col("reason") == "missing_id") & (F.col("bad_fields") == "")
    sound = F.col("reason").isNull() | no_id

    def shown(field: str) -> Column:
        there = F.col("reason").isNull() if field == "question_id" else sound
        return F.when(there, F.col(f"post.{field}")).alias(field)

    return checked.select(
        *[shown(field) for field in fields],
        F.when(~sound, error_reason()).alias("error_reason"),
        F.when(~sound, F.col(value)).alias("raw"),
    )


def kafka_rows(records: DataFrame) -> DataFrame:
    """Records of Spark's Kafka source in the frame shape of this library.

    Of headers with one key, which Kafka allows, the last counts.
    """
    headers = F.coalesce("headers", F.array())
    names = F.array_distinct(F.transform(headers, lambda header: header["key"]))
    last = F.transform(
        names,
        lambda name: F.struct(
            name.alias("key"),
            F.element_at(F.filter(headers, lambda header: header["key"] == name), -1)["value"]
            .cast("string")
            .alias("value"),
        ),
    )
    return records.select(
        F.concat_ws("-", "topic", "partition", "offset").alias("message_id"),
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.map_from_entries(last).alias("attributes"),
        F.col("timestamp").alias("publish_ts"),
        "partition",
        F.col("offset").alias("seq"),
    )


def kafka_messages(
    spark: SparkSession,
    servers: str,
    topic: str,
    streaming: bool = True,
    starting: str = "earliest",
    max_offsets: int = 1_000_000,
) -> DataFrame:
    """A Kafka topic in the frame shape of this library.

    Needs the public spark-sql-kafka connector on the class path. ``starting``
    is "earliest" for a read from the beginning, "latest" for a subscription
    that sees new messages only (streams), or a JSON text of offsets. ``max_offsets``
    bounds each micro-batch, which streams here keep in memory or on disk while it is stored.
    """
    if not streaming and starting == "latest":
        raise ValueError("a batch read has no new messages: start at 'earliest' or at offsets")
    reader = (spark.readStream if streaming else spark.read).format("kafka")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "includeHeaders": "true",
    }
    if streaming:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return kafka_rows(reader.options(**options).load())
