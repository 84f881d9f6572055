"""Tables written to the shared folder, which cut lineage and outlive executors."""

from __future__ import annotations

import ctypes
import os

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from postloom.session import scratch_path

# Bytes of rows, about, that Python workers are given at once. A batch is held several
# times over: in the buffers of the executor, in the worker, and in what is made of it.
BATCH_BYTES = 4 << 20
_BATCHES = "spark.sql.execution.arrow.maxBytesPerBatch"

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def share_package(spark: SparkSession) -> None:
    """Let Python workers of this machine import the package from any folder.

    Executors of a cluster get it the usual way (``--py-files`` or installed).
    """
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(":")
    if _ROOT not in paths:
        environment["PYTHONPATH"] = ":".join([_ROOT, *filter(None, paths)])


def bound_batches(spark: SparkSession) -> None:
    """Give Python workers batches of ``BATCH_BYTES`` at most, or of the session's bound if less."""
    if int(spark.conf.get(_BATCHES).removesuffix("b")) > BATCH_BYTES:
        spark.conf.set(_BATCHES, BATCH_BYTES)


def give_back() -> None:
    """Return the memory that a worker has freed, which its allocators hold on to otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library
    if trim is not None:
        trim(0)


def stored(frame: DataFrame, label: str) -> DataFrame:
    """The rows of ``frame``, written once below ``spark.checkpoint.dir`` and reread."""
    spark = frame.sparkSession
    path = scratch_path(spark, label)
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parallelism(spark: SparkSession) -> int:
    """Partitions that a shuffle of this session has."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
