"""Keeping a costly expression from being worked out twice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pin(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add ``value`` as a column that is worked out once per row.

    The optimizer copies an ordinary projected expression into every filter
    it pushes below the projection, so JSON text would be parsed once for the
    filter and again for the output. It does not push filters below a
    generator, and exploding an array of one element keeps the row count and
    stays within the same code-generated stage.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))
