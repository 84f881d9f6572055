"""Offsets and key positions that go on from one micro-batch to the next.

Each batch stores how many messages every key of it has; positions within a batch start
where the batches before it end. Totals are written every so many batches, so a batch
reads one of these and the counts since then, however long the stream has run. A batch
that is run again replaces its rows and its counts.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from postloom.operators.messaging import keyed_order
from postloom.sinks.files import Batch, batch_folder
from postloom.sinks.parts import existing
from postloom.streaming.ingest import run_batches

TOTALS_EVERY = 20

_COUNTS = "partition int, key string, messages bigint"


def _counts(spark: SparkSession, root: str, *folders: str) -> DataFrame:
    return existing(spark, _COUNTS, root, *folders).select("partition", "key", "messages")


def counts_before(spark: SparkSession, root: str, own: Batch, every: int = TOTALS_EVERY) -> DataFrame:
    """Messages of each key in all batches of the run before this one."""
    last = own.number // every * every - 1
    wanted = [] if last < 0 else [batch_folder(f"{root}/totals", Batch(own.run, last))]
    wanted += [
        batch_folder(f"{root}/counts", Batch(own.run, n)) for n in range(last + 1, own.number)
    ]
    if not wanted:
        return spark.createDataFrame([], _COUNTS)
    counts = _counts(spark, root, *wanted)
    return counts.groupBy("partition", "key").agg(F.sum("messages").alias("messages"))


def continued(batch: DataFrame, before: DataFrame, partitions: int = 3) -> DataFrame:
    """The rows of a batch with partition, offset and key_position counted on.

    ``batch`` has ``seq`` (the order of arrival, a whole number) and ``key``; a null key
    is a key of its own. ``before`` holds partition, key and messages of what came earlier.
    """
    numbered = keyed_order(batch, partitions)
    of_key = before.select(
        F.col("partition").alias("_p"), F.col("key").alias("_k"), F.col("messages").alias("_of_key")
    )
    of_partition = before.groupBy(F.col("partition").alias("_p")).agg(
        F.sum("messages").alias("_of_partition")
    )
    same = (F.col("partition") == F.col("_p")) & F.col("key").eqNullSafe(F.col("_k"))
    return (
        numbered.join(of_key, same, "left")
        .drop("_p", "_k")
        # One row for each partition of the topic.
        .join(F.broadcast(of_partition), F.col("partition") == F.col("_p"), "left")
        .withColumns(
            {
                "offset": F.col("offset") + F.coalesce("_of_partition", F.lit(0)),
                "key_position": F.col("key_position") + F.coalesce("_of_key", F.lit(0)),
            }
        )
        .drop("_p", "_of_key", "_of_partition")
    )


def start_keyed_order(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    partitions: int = 3,
    every: int = TOTALS_EVERY,
    available_now: bool = True,
) -> StreamingQuery:
    """Store a stream of keyed messages with their offsets and key positions.

    Rows go to ``root/rows``, counts to ``root/counts`` and, every so many batches, totals
    to ``root/totals``, each by run and batch. The order of a topic is that of its batches,
    and of ``seq`` within one. Positions start at 0 in every checkpoint.
    """

    def write(batch: DataFrame, own: Batch) -> None:
        spark = batch.sparkSession
        before = counts_before(spark, root, own, every)
        placed = continued(batch, before, partitions).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            placed.write.mode("overwrite").parquet(batch_folder(f"{root}/rows", own))
            counts = placed.groupBy("partition", "key").agg(F.count("*").alias("messages"))
            counts.write.mode("overwrite").parquet(batch_folder(f"{root}/counts", own))
        finally:
            placed.unpersist()
        if own.number % every == every - 1:
            after = before.unionByName(_counts(spark, root, batch_folder(f"{root}/counts", own)))
            (
                after.groupBy("partition", "key")
                .agg(F.sum("messages").alias("messages"))
                .write.mode("overwrite")
                .parquet(batch_folder(f"{root}/totals", own))
            )

    return run_batches(messages, write, checkpoint, available_now)
