"""Writing and reading the landing formats.

A write that takes a ``Batch`` goes to the ``run=`` and ``batch=`` folders of its own
and replaces them, so a batch that is run again after a failure leaves one copy,
and a stream with another checkpoint, whose batches count from 0 again, replaces
nothing. What a broker delivers twice is kept twice; the readers of the last
delivery give one row for each message id or object.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postloom.functions import post_json
from postloom.functions.timekeys import hour_keys
from postloom.operators.newest import first_per_key
from postloom.schema import HOUR_KEYS, with_hour_keys
from postloom.session import dropped_shuffles
from postloom.sinks.versions import (
    claim_version,
    done_versions,
    publish_version,
    version_folder,
)


# JSON and envelopes shrink to two fifths; more effort takes thrice the time for a tenth.
PACKED = {"compression": "gzip", "zlib.compress.level": "THREE"}
# A packed file is read by one task, whatever its size.
PACKED_ROWS = 1 << 17
# Of the stored posts' parquet files.
STORE_CODEC = "zstd"


@dataclass(frozen=True)
class Batch:
    """A micro-batch: the id of the stream's checkpoint, and the batch's number in it."""

    run: str
    number: int


def batch_folder(root: str, batch: Batch | None) -> str:
    """Folder of one batch, or the root itself for an unbatched write."""
    return root if batch is None else f"{root}/run={batch.run}/batch={batch.number}"


def spread(df: DataFrame, *partition_keys: str) -> DataFrame:
    """Bring the rows of each output partition together before a write.

    Without this every task would open a file in every partition it meets. A
    rebalance, unlike ``repartition``, lets adaptive execution split an
    oversized partition over several tasks and pack small ones into one.
    """
    return df.hint("rebalance", *partition_keys)


def write_json_archive(
    posts: DataFrame, root: str, batch: Batch | None = None
) -> None:
    """Archive decoded posts as JSON lines, the message id beside each.

    ``posts`` has ``message_id``, the struct ``post`` and, where known, the order of
    arrival (``landed_at``, ``position``). Nulls are kept.
    """
    arrival = [c for c in ("landed_at", "position") if c in posts.columns]
    (
        posts.select("message_id", "post", *arrival)
        .write.mode("overwrite")
        .option("ignoreNullFields", "false")
        .options(**PACKED)
        .json(batch_folder(root, batch))
    )


def read_json_archive(spark: SparkSession, root: str) -> DataFrame:
    """Archived posts as (message_id, json text).

    Only these two are asked for, so an object comes back as its own text.
    """
    return spark.read.schema("message_id string, post string").json(root).select(
        "message_id", F.col("post").alias("json")
    )


def last_delivery(rows: DataFrame, *keys: str) -> DataFrame:
    """The row of each key that arrived last; rows with a null key all stay.

    The rows are read once: one with a null key gets a number of its own as a further
    key, which also spreads such rows over the tasks.
    """
    unknown = F.lit(False)
    for key in keys:
        unknown = unknown | F.col(key).isNull()
    numbered = rows.withColumn("_own", F.when(unknown, F.monotonically_increasing_id()))
    order = [F.desc("landed_at"), F.desc("position")]
    return first_per_key(numbered, [*keys, "_own"], order).drop("_own")


def latest_archive(spark: SparkSession, root: str) -> DataFrame:
    """The archive with one object for each message id: the one delivered last."""
    schema = "message_id string, post string, landed_at timestamp, position bigint"
    rows = last_delivery(spark.read.schema(schema).json(root), "message_id")
    return rows.select("message_id", F.col("post").alias("json"))


def latest_objects(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The hour layout with one object for each question and hour: the last delivered."""
    rows = read_hour_partitions(spark, root, schema)
    return last_delivery(rows, *HOUR_KEYS, "question_id")


def compact_hours(spark: SparkSession, root: str, target: str, schema: T.StructType) -> None:
    """Rewrite a streamed hour layout to ``target`` with few files for each hour."""
    rows = read_hour_partitions(spark, root, schema).select(*schema.fieldNames(), *HOUR_KEYS)
    (
        spread(rows, *HOUR_KEYS)
        .sortWithinPartitions(*HOUR_KEYS, "question_id")
        .write.mode("overwrite")
        .partitionBy(*HOUR_KEYS)
        .parquet(target)
    )


def with_hour(posts: DataFrame, epoch: str = "creation_date") -> DataFrame:
    """Add the four hour partition columns."""
    return posts.withColumns(hour_keys(F.col(epoch)))


def write_hour_partitions(
    posts: DataFrame,
    root: str,
    batch: Batch | None = None,
    epoch: str = "creation_date",
) -> None:
    """Parquet under ``year=/month=/day=/hour=``, ordered by question.

    The folders of run and batch lie below the hour, so a read of one hour lists
    that hour only; ``compact_hours`` rewrites what streams have cut small.
    """
    rows = spread(with_hour(posts, epoch), *HOUR_KEYS)
    writer = rows.sortWithinPartitions(*HOUR_KEYS, "question_id").write.mode("overwrite")
    keys = HOUR_KEYS
    if batch is not None:
        rows = rows.withColumns({"run": F.lit(batch.run), "batch": F.lit(batch.number)})
        keys = [*HOUR_KEYS, "run", "batch"]
        writer = (
            rows.sortWithinPartitions(*HOUR_KEYS, "question_id")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
        )
    # One question is looked up in all hours: its filter skips row groups without it. The
    # filter's size follows the questions of a file; of a fixed size it is 1 MB for each hour.
    (
        writer.option("compression", STORE_CODEC)
        .option("parquet.bloom.filter.enabled#question_id", "true")
        .option("parquet.bloom.filter.adaptive.enabled", "true")
        .option("parquet.bloom.filter.candidates.number", "12")
        .partitionBy(*keys)
        .parquet(root)
    )


def lookup_questions(
    spark: SparkSession, root: str, schema: T.StructType, question_ids: list[int]
) -> DataFrame:
    """All stored captures of a few questions, from the hour layout.

    The ids reach the scan, which skips row groups by their bounds and Bloom filters.
    """
    rows = read_hour_partitions(spark, root, schema)
    return rows.filter(F.col("question_id").isin(*question_ids))


def read_hour_partitions(
    spark: SparkSession, root: str, schema: T.StructType
) -> DataFrame:
    """Read the hour layout; ``schema`` holds the columns inside the files."""
    return spark.read.schema(with_hour_keys(schema)).parquet(root)


def append_table(df: DataFrame, root: str, batch: Batch | None = None) -> None:
    """Append to a parquet table; the new rows may have new columns."""
    writer = df.write.option("compression", STORE_CODEC)
    if batch is None:
        writer.mode("append").parquet(root)
    else:
        writer.mode("overwrite").parquet(batch_folder(root, batch))


def read_appended(
    spark: SparkSession, root: str, schema: T.StructType | None = None
) -> DataFrame:
    """Read an appended table; columns that older files lack are null.

    With the schema at hand no file footer is read to find it out; without,
    a Spark job merges the footers.
    """
    if schema is not None:
        return spark.read.schema(schema).parquet(root)
    return spark.read.option("mergeSchema", "true").parquet(root)


def replace_table(df: DataFrame, root: str, partition: str, cluster: str) -> None:
    """Full refresh, partitioned by a date and sorted within by ``cluster``.

    The sort gives each row group a narrow range of cluster values, so a
    filter on them skips the others. The rows go to a folder of their own number, which
    is then marked as done: readers (``read_table``) see the old table until then, and
    a refresh that fails leaves the old one.
    """
    spark = df.sparkSession
    number = claim_version(spark, root)
    (
        spread(df, partition)
        .sortWithinPartitions(partition, cluster)
        .write.partitionBy(partition)
        .parquet(version_folder(root, number))
    )
    publish_version(spark, root, number)


def read_table(
    spark: SparkSession, root: str, schema: T.StructType | None = None
) -> DataFrame:
    """The newest version of a table that ``replace_table`` wrote.

    Versions count up whatever the clock says; ``drop_versions`` removes old ones.
    """
    done = done_versions(spark, root)
    if not done:
        raise FileNotFoundError(f"no version of {root} has been written")
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(version_folder(root, done[-1]))


def write_routed(checked: DataFrame, root: str, batch: Batch | None = None) -> None:
    """Write valid and faulty messages in one pass, apart by ``route``."""
    (
        checked.write.mode("overwrite")
        .partitionBy("route")
        .parquet(batch_folder(root, batch))
    )


def write_topic(
    lines: DataFrame, path: str, value: str = "value", packed: bool = False
) -> None:
    """Replace a topic folder with the given lines.

    ``packed`` files are compressed, and cut so that a task reads ``PACKED_ROWS`` at most.
    """
    writer = lines.select(F.col(value).alias("value")).write.mode("overwrite")
    if packed:
        writer = writer.options(**PACKED).option("maxRecordsPerFile", PACKED_ROWS)
    with dropped_shuffles(lines.sparkSession):
        writer.text(path)


def as_lines(posts: DataFrame) -> DataFrame:
    """Posts as JSON lines for a topic folder."""
    record = F.struct(*[F.col(name) for name in posts.columns])
    return posts.select(post_json(record).alias("value"))


def to_kafka_rows(published: DataFrame) -> DataFrame:
    """Published messages in the shape of Spark's Kafka sink.

    Use ``.write`` or ``.writeStream`` with ``format("kafka")`` on the result.
    """
    headers = F.transform(
        F.map_entries("attributes"),
        lambda pair: F.struct(
            pair["key"].alias("key"), pair["value"].cast("binary").alias("value")
        ),
    )
    return published.select("key", "value", headers.alias("headers"))


def store_results(results: DataFrame, root: str) -> None:
    """Store check results in a table partitioned by run and table checked.

    A run that is repeated replaces its own results.
    """
    (
        results.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id", "table_name")
        .parquet(root)
    )
