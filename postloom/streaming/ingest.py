"""Streams that store messages, route dead letters and drop redeliveries."""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from postloom.functions import epoch_day
from postloom.operators.contract import check_contract, dead_letters, routed, valid_posts
from postloom.plans.landing import flattened, land, receive, unflattened, without_spent_text
from postloom.session import dropped_shuffles
from postloom.sinks.commits import land_committed
from postloom.sinks.files import Batch, spread, write_routed


# Parts that messages without a publish time are dealt over.
UNTIMED_PARTS = 256


def run_batches(
    stream: DataFrame,
    write: Callable[[DataFrame, Batch], None],
    checkpoint: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Start a query that hands each micro-batch to ``write``.

    A batch that fails is run again from the checkpoint under the same number;
    ``write`` has to replace what that batch wrote before. Numbers start at 0 in every
    checkpoint, so a batch also carries the id that Spark keeps in the checkpoint.
    """

    def numbered(batch: DataFrame, number: int) -> None:
        run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not run:
            raise RuntimeError("the stream has no id")
        write(batch, Batch(run, number))

    writer = stream.writeStream.foreachBatch(numbered).option(
        "checkpointLocation", checkpoint
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


@contextlib.contextmanager
def _received_once(batch: DataFrame, missing_id: str) -> Iterator[DataFrame]:
    """A received batch that is cached while it is stored, and leaves no shuffle files.

    The part of the cache that memory does not hold lies on disk, as it is: plain columns
    without the text of stored messages take a fraction of whole rows.
    """
    received = without_spent_text(receive(batch, missing_id))
    flat = flattened(received).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        with dropped_shuffles(batch.sparkSession):
            yield unflattened(flat)
    finally:
        flat.unpersist()


def start_ingest(
    lines: DataFrame,
    root: str,
    checkpoint: str,
    missing_id: str = "zero",
    available_now: bool = True,
) -> StreamingQuery:
    """Store a stream of envelopes in all stores under ``root``.

    Each micro-batch is cached while its four outputs are written, so messages are
    parsed once; the source has to bound it (``stream_topic`` asks for a limit). Spark
    works lost cached blocks out again from the source.
    """

    def write(batch: DataFrame, own: Batch) -> None:
        with _received_once(batch, missing_id) as received:
            land(received, root, own)

    return run_batches(lines, write, checkpoint, available_now)


def start_committed_ingest(
    lines: DataFrame,
    root: str,
    checkpoint: str,
    missing_id: str = "zero",
    available_now: bool = True,
) -> StreamingQuery:
    """As ``start_ingest``, with one commit for the four stores of each batch.

    ``read_committed`` shows a batch in all stores or in none. A batch that fails before
    its commit is written anew; one that fails after it is passed over.
    """

    def write(batch: DataFrame, own: Batch) -> None:
        with _received_once(batch, missing_id) as received:
            land_committed(received, root, own)

    return run_batches(lines, write, checkpoint, available_now)


def start_routing(
    lines: DataFrame,
    root: str,
    checkpoint: str,
    missing_id: str = "zero",
    available_now: bool = True,
) -> StreamingQuery:
    """Check raw messages and write both routes of each batch in one pass."""

    def write(batch: DataFrame, own: Batch) -> None:
        write_routed(routed(check_contract(batch, missing_id=missing_id)), root, own)

    return run_batches(lines, write, checkpoint, available_now)


def routed_letters(written: DataFrame, **options: object) -> DataFrame:
    """Dead letters of a routed table; reads that route's files only."""
    return dead_letters(written.filter(F.col("route") == "dead"), **options)


def routed_posts(written: DataFrame) -> DataFrame:
    """Valid posts of a routed table; reads that route's files only."""
    return valid_posts(written.filter(F.col("route") == "main"))


def drop_redelivered(
    messages: DataFrame, delay: str, publish_ts: str = "publish_ts"
) -> DataFrame:
    """First delivery of each message of a stream.

    A redelivered message keeps its id and publish time. State is held for
    ``delay`` only, which must be no less than the time a broker may still
    redeliver: Spark drops older rows as late, and counts them in the query's
    progress (``numRowsDroppedByWatermark``). Where there is no such bound use
    ``start_first_deliveries``. Messages without an id cannot be told apart and all stay.
    """
    timed = messages.withWatermark(publish_ts, delay)
    once = timed.filter(F.col("message_id").isNotNull()).dropDuplicatesWithinWatermark(
        ["message_id"]
    )
    return once.unionByName(timed.filter(F.col("message_id").isNull()))


def _known_ids(
    spark: SparkSession, root: str, days: list[str], own: Batch
) -> DataFrame | None:
    """Ids that other batches, of any run, stored under the given days, if any.

    Only the folders of these days are listed, so the cost of a batch does
    not grow with the age of the table.
    """
    schema = "message_id string, publish_day string, run string, batch bigint"
    folders = f"{root}/publish_day={{{','.join(days)}}}"
    try:
        rows = spark.read.option("basePath", root).schema(schema).parquet(folders)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    # A batch that is run again must not meet its own first attempt.
    first_attempt = (F.col("run") == own.run) & (F.col("batch") == own.number)
    return rows.filter(~first_attempt).select("message_id")


def _first_of_each(rows: DataFrame, stored: DataFrame | None) -> DataFrame:
    """One row of each message id that is not stored.

    Stored ids go through the same shuffle as rows of their own, so that rows are moved and
    sorted once for both.
    """
    both = rows.withColumn("_stored", F.lit(False))
    if stored is not None:
        ids = stored.withColumn("_stored", F.lit(True))
        both = both.unionByName(ids, allowMissingColumns=True)
    order = Window.partitionBy("message_id").orderBy(F.desc("_stored"))
    # A row number would add a group limit, which sorts the rows before the shuffle as well.
    ranked = both.withColumn("_before", F.lag("message_id").over(order))
    return ranked.filter(F.col("_before").isNull() & ~F.col("_stored")).drop("_before", "_stored")


def _untimed_part() -> Column:
    """Where a message without a publish time goes: "none-" and a hash of its id."""
    part = F.pmod(F.xxhash64("message_id"), F.lit(UNTIMED_PARTS)).cast("string")
    return F.when(F.col("message_id").isNull(), "none").otherwise(F.concat(F.lit("none-"), part))


def start_first_deliveries(
    messages: DataFrame, root: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Append messages that ``root`` does not hold yet, however late they are.

    The table is partitioned by publish day (UTC), run and batch. As a redelivery
    keeps its publish time, a batch is compared with the ids of its own days only,
    and no streaming state is kept. Messages without a publish time are dealt by their id
    over ``UNTIMED_PARTS`` parts, of which a batch lists those of its own ids. A batch that
    is run again replaces the partitions of its first attempt. Messages without an id
    all stay, and are never compared.
    """

    def write(batch: DataFrame, own: Batch) -> None:
        published = epoch_day(F.unix_seconds("publish_ts")).cast("string")
        known = F.col("message_id").isNotNull()
        dated = batch.withColumn("publish_day", F.coalesce(published, _untimed_part()))
        # At most one row per calendar day and part comes to the driver.
        named = dated.filter(known).select("publish_day").distinct()
        days = [row[0] for row in named.collect()]
        stored = _known_ids(batch.sparkSession, root, days, own) if days else None
        new = _first_of_each(dated.filter(known), stored).unionByName(dated.filter(~known))
        numbered = new.withColumns(
            {"run": F.lit(own.run), "batch": F.lit(own.number).cast("bigint")}
        )
        (
            spread(numbered, "publish_day")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("publish_day", "run", "batch")
            .parquet(root)
        )

    return run_batches(messages, write, checkpoint, available_now)
