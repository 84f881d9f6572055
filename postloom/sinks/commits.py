"""One commit for all stores of a micro-batch.

The stores of a batch are written first, each to the batch's own folder; then one
manifest row names the batch, with the numbers of rows stored and refused. Readers take the batches that
the manifest names, so a batch that died between two stores is not seen in any, and a
batch whose row is there is not written again. Batches of a run are committed in
their order: per run the highest number tells them all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postloom.plans.landing import land
from postloom.schema import STORED, with_hour_keys
from postloom.sinks.files import Batch
from postloom.sinks.parts import existing

STORES = ("json", "parquet", "table", "dead_letters")

_KEYS = [T.StructField("run", T.StringType()), T.StructField("batch", T.LongType())]
MANIFEST = T.StructType(
    [T.StructField("stored", T.LongType()), T.StructField("refused", T.LongType()), *_KEYS]
)

LETTERS = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in ("message_id", "raw", "error_reason", "failed_stage", "source", "timestamp")
    ]
)
ARCHIVE = T.StructType([T.StructField(name, T.StringType()) for name in ("message_id", "post")])


def manifest(spark: SparkSession, root: str, run: str | None = None) -> DataFrame:
    """Committed batches of all runs, or of one, with their numbers of rows."""
    base = f"{root}/manifest"
    return existing(spark, MANIFEST, base, base if run is None else f"{base}/run={run}")


def is_committed(spark: SparkSession, root: str, batch: Batch) -> bool:
    """Whether the batch was committed before; looks at its own folder only."""
    base = f"{root}/manifest"
    own = existing(spark, MANIFEST, base, f"{base}/run={batch.run}/batch={batch.number}")
    return not own.isEmpty()


def land_committed(received: DataFrame, root: str, batch: Batch) -> bool:
    """Write a received batch to all stores and commit it; False where it was before.

    ``received`` (see ``plans.landing.receive``) is read once for each store and once
    for the counts; a caller whose batch is costly to work out caches it first.
    """
    spark = received.sparkSession
    if is_committed(spark, root, batch):
        return False
    counts = received.agg(
        F.count_if(F.col("failed_stage").isNull()).alias("stored"),
        F.count_if(F.col("failed_stage").isNotNull()).alias("refused"),
    )
    land(received, root, batch)
    (
        counts.write.mode("overwrite")
        .parquet(f"{root}/manifest/run={batch.run}/batch={batch.number}")
    )
    return True


def committed_only(rows: DataFrame, root: str) -> DataFrame:
    """Rows (with ``run`` and ``batch``) of committed batches.

    The manifest comes down to one row a run before it is joined, so the join stays
    small however many batches there are, and its keys prune the folders of other runs.
    """
    last = (
        manifest(rows.sparkSession, root)
        .groupBy(F.col("run").alias("_run"))
        .agg(F.max("batch").alias("_last"))
    )
    there = (F.col("run") == F.col("_run")) & (F.col("batch") <= F.col("_last"))
    return rows.join(last, there, "left_semi").drop("run", "batch")


def read_committed(spark: SparkSession, root: str, store: str) -> DataFrame:
    """The rows of one store in committed batches; empty before the first commit."""
    inside = {
        "json": ARCHIVE,
        "parquet": with_hour_keys(STORED),
        "table": STORED,
        "dead_letters": LETTERS,
    }[store]
    schema = T.StructType([*inside.fields, *_KEYS])
    base = f"{root}/{store}"
    if store != "json":
        return committed_only(existing(spark, schema, base), root)
    if manifest(spark, root).isEmpty():
        return spark.createDataFrame([], "message_id string, json string")
    rows = committed_only(spark.read.schema(schema).json(base), root)
    return rows.select("message_id", F.col("post").alias("json"))
