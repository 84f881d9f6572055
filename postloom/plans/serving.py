"""Dashboard queries over gold."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.schema import SENTIMENTS


def date_range(
    gold: DataFrame, start: datetime.date, end: datetime.date
) -> DataFrame:
    """Days from ``start`` to ``end``; prunes a table partitioned by day."""
    return gold.filter(F.col("report_date").between(start, end))


def with_sentiments(gold: DataFrame, chosen: list[str]) -> DataFrame:
    """The chosen classes."""
    return gold.filter(F.col("sentiment").isin(*chosen))


def trend_long(gold: DataFrame) -> DataFrame:
    """Posts by day and class, one row each."""
    return gold.groupBy("report_date", "sentiment").agg(
        F.sum("post_count").alias("post_count")
    )


def trend_wide(gold: DataFrame) -> DataFrame:
    """Posts by day, one column per class; the classes are fixed."""
    return gold.groupBy("report_date").pivot("sentiment", SENTIMENTS).agg(
        F.sum("post_count")
    )
