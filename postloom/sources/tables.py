"""Tables and views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def base_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One parquet table of a data folder."""
    return spark.read.parquet(f"{root}/{name}.parquet")


def expose_view(df: DataFrame, name: str) -> DataFrame:
    """Register the frame under a name, without copying it."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def latest_batch(df: DataFrame, batch: str = "batch_id") -> DataFrame:
    """The rows of the newest batch.

    The maximum is a scalar subquery: on a table partitioned by the batch it
    prunes the scan to one partition.
    """
    return df.filter(F.col(batch) == df.agg(F.max(batch)).scalar())
