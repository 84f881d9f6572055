"""A stream for each subscription, with progress and a start time of its own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from postloom.operators.messaging import Subscription, subscribe
from postloom.sinks.files import Batch, batch_folder
from postloom.sinks.versions import exists
from postloom.streaming.ingest import run_batches

_INDEX = "path string, messages bigint, first_publish timestamp, last_publish timestamp, untimed bigint"


def _store(root: str) -> Callable[[DataFrame, Batch], None]:
    """Write each batch to its own folder below ``root``."""

    def write(rows: DataFrame, own: Batch) -> None:
        rows.write.mode("overwrite").parquet(batch_folder(root, own))

    return write


def start_subscription(
    messages: DataFrame,
    subscription: Subscription,
    root: str,
    checkpoint: str,
    write: Callable[[DataFrame, Batch], None] | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Start one subscription's own stream; rows go below ``root/<name>``.

    Its filter by attributes and start time runs before anything else of a batch. The
    checkpoint below ``checkpoint/<name>`` is its own: it fails, stops, resumes and falls
    behind alone. ``write`` may replace the plain store of files.
    """
    write = write or _store(f"{root}/{subscription.name}")
    return run_batches(
        subscribe(messages, subscription),
        write,
        f"{checkpoint}/{subscription.name}",
        available_now,
    )


def start_fan_out(
    messages: DataFrame,
    subscriptions: list[Subscription],
    root: str,
    checkpoint: str,
    writers: dict[str, Callable[[DataFrame, Batch], None]] | None = None,
    available_now: bool = True,
) -> dict[str, StreamingQuery]:
    """One stream for each subscription, by name.

    Every subscription reads the topic itself, as brokers deliver to each, so none
    waits for another; for one pass over a batch for all see ``messaging.fan_out``.
    """
    names = [s.name for s in subscriptions]
    if len(set(names)) != len(names):
        raise ValueError("subscriptions need different names")
    writers = writers or {}
    return {
        s.name: start_subscription(
            messages, s, root, checkpoint, writers.get(s.name), available_now
        )
        for s in subscriptions
    }


def index_topic(spark: SparkSession, topic: str, schema: T.StructType, index: str) -> None:
    """Add the publish times of the topic's files that the index does not list yet.

    A file's row has its path, its number of messages, the first and last publish time,
    and how many messages have none. Files are written once and never changed.
    """
    whole = spark.read.schema(schema).parquet(topic)
    rows = whole.select("publish_ts", F.col("_metadata.file_path").alias("path"))
    known = _read_index(spark, index)
    if known is not None:
        # File paths are constants of a task, so listed files are not decoded.
        rows = rows.join(known.select("path"), "path", "left_anti")
    (
        rows.groupBy("path")
        .agg(
            F.count("*").alias("messages"),
            F.min("publish_ts").alias("first_publish"),
            F.max("publish_ts").alias("last_publish"),
            F.count_if(F.col("publish_ts").isNull()).alias("untimed"),
        )
        .write.mode("append")
        .parquet(index)
    )


def _read_index(spark: SparkSession, index: str) -> DataFrame | None:
    return spark.read.schema(_INDEX).parquet(index) if exists(spark, index) else None


def start_from_time(
    spark: SparkSession,
    index: str,
    schema: T.StructType,
    subscription: Subscription,
    root: str,
    checkpoint: str,
    max_files: int = 1,
    write: Callable[[DataFrame, Batch], None] | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """A subscription that opens only the topic files with messages since its start.

    The stream follows the index (``index_topic``): of each batch of its rows, the files
    whose last publish time is not before the start are read, and their messages filtered.
    ``max_files`` bounds the index files of a batch, each of which lists what one call of
    ``index_topic`` has found.
    """
    write = write or _store(f"{root}/{subscription.name}")

    def follow(listed: DataFrame, own: Batch) -> None:
        session = listed.sparkSession
        since = subscription.start()
        wanted = listed if since is None else listed.where(F.col("last_publish") >= since)
        # The paths of one bounded batch.
        paths = sorted(row["path"] for row in wanted.select("path").distinct().collect())
        rows = (
            session.read.schema(schema).parquet(*paths)
            if paths
            else session.createDataFrame([], schema)
        )
        write(subscribe(rows, subscription), own)

    stream = spark.readStream.schema(_INDEX).option("maxFilesPerTrigger", max_files)
    return run_batches(
        stream.parquet(index), follow, f"{checkpoint}/{subscription.name}", available_now
    )
