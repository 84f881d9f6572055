"""Sharding by a two-pass external shuffle.

First pass: each record goes to one of many buckets by a seeded hash of its place
in the input, whatever it holds, so that buckets are alike in size however often
a key or text is repeated; there are as many buckets as keep one within memory.
Second pass: each bucket is put into the order of its places, shuffled by Fisher
and Yates with a generator seeded for the bucket, and written. The buckets in a row
are one permutation of all records, which is cut into shards whose counts are at
most one apart.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postloom.llm.storage import stored

SEED = 20_240_601
BUCKET_BYTES = 24 << 20
RUN_OF = 4_096  # buckets
ROW_BYTES = 16  # counted for a record beside its text


def fisher_yates(count: int, seed: list[int]) -> np.ndarray:
    """A permutation of ``count`` places; the swaps of numpy's shuffle are Fisher and Yates'."""
    order = np.arange(count)
    np.random.default_rng(seed).shuffle(order)
    return order


def record_size(text: str = "text"):
    """UTF-8 bytes of a record's text (null: none) and a fixed part."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES


def shuffled(
    docs: DataFrame, shards: int, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """All records with their columns, and ``shard`` and ``slot`` in a random order.

    Columns of ``docs`` that are named shard or slot give way to these; all others stay,
    whatever their names. The same input files, read in the same splits, and seed give
    the same order, also when tasks are run again. Nulls are records like others, repeated
    rows are placed each, an empty table gives no rows; with fewer records than shards
    some shards are empty.
    """
    keep = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    mark = "_"
    while any(c.lower().startswith(mark) for c in keep):
        mark += "_"
    row_, bucket_, at_, base_, shard_ = (mark + n for n in ("row", "bucket", "at", "base", "shard"))
    source = docs.select(*(F.col(f"`{c}`") for c in keep))
    total = source.agg(F.sum(record_size()), F.count("*")).first()
    rows = total[1]
    buckets = max(1, math.ceil((total[0] or 0) / bucket_bytes))
    scattered = source.withColumn(row_, F.monotonically_increasing_id()).withColumn(
        bucket_, F.pmod(F.xxhash64(F.lit(seed), row_), F.lit(buckets)).cast("int")
    )

    def shuffle(key: tuple, bucket: pa.Table) -> pa.Table:
        places = np.argsort(bucket.column(row_).to_numpy(), kind="stable")
        order = places[fisher_yates(len(places), [seed, key[0].as_py()])]
        at = pa.array(np.arange(len(order)), pa.int64())
        return bucket.take(pa.array(order)).drop_columns([row_]).append_column(at_, at)

    schema = T.StructType(
        [f for f in scattered.schema.fields if f.name != row_] + [T.StructField(at_, T.LongType())]
    )
    done = stored(scattered.groupBy(bucket_).applyInArrow(shuffle, schema), "shuffled")
    base = _starts(done.groupBy(F.col(bucket_).alias("bucket")).agg(F.count("*").alias("n")))
    base = base.select(F.col("bucket").alias(bucket_), F.col("before").alias(base_))
    place = F.col(base_) + F.col(at_)
    shard = F.expr(f"({base_} + {at_}) * {shards}L DIV {max(rows, 1)}L")
    first = F.expr(f"({shards}L - 1 + {max(rows, 1)}L * {shard_}) DIV {shards}L")
    return (
        done.join(base, bucket_)
        .withColumn(shard_, shard)
        .select(
            *(F.col(f"`{c}`") for c in keep),
            F.col(shard_).cast("int").alias("shard"),
            (place - first).alias("slot"),
        )
    )


def _starts(sizes: DataFrame) -> DataFrame:
    """bucket and before (records of all buckets below it), by sums of runs of buckets.

    A task sees one run of ``RUN_OF`` buckets, and one task a row for each run.
    """
    run = F.floor(F.col("bucket") / RUN_OF)
    sizes = stored(sizes.withColumn("run", run), "shuffled-sizes")
    earlier = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = sizes.groupBy("run").agg(F.sum("n").alias("n")).select(
        "run", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("of_run")
    )
    within = Window.partitionBy("run").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    inside = sizes.withColumn("inside", F.coalesce(F.sum("n").over(within), F.lit(0)))
    return inside.join(runs, "run").select(
        "bucket", (F.col("of_run") + F.col("inside")).alias("before")
    )


def write_shards(docs: DataFrame, path: str, shards: int, seed: int = SEED) -> None:
    """Write the shuffled records as one folder for each shard, in slot order."""
    placed = shuffled(docs, shards, seed)
    (
        placed.repartitionByRange(shards, "shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(path)
    )


def shard_digests(docs: DataFrame, shards: int = 40, seed: int = SEED) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every record."""
    return shuffled(docs.select("doc_id", "text"), shards, seed).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        record_size().alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
