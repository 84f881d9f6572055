"""Engagement classes and change rates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def filled(value: Column) -> Column:
    """The value with null read as zero."""
    return F.coalesce(value, F.lit(0))


def sentiment(score: Column, answers: Column) -> Column:
    """Engagement class by votes and answers; the first rule that holds wins."""
    votes, replies = filled(score), filled(answers)
    return (
        F.when((votes >= 50) & (replies >= 10), "HIGH_ENGAGEMENT")
        .when(votes >= 20, "POSITIVE")
        .when(votes < 0, "NEGATIVE")
        .otherwise("NEUTRAL")
    )


def percent_change(current: Column, previous: Column) -> Column:
    """Change in percent; null where there is nothing above zero to compare."""
    return F.when(previous > 0, (current - previous) / previous * 100)
