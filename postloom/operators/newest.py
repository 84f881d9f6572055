"""Keeping one row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(
    df: DataFrame, keys: list[Column | str], order: list[Column]
) -> DataFrame:
    """The first row of each key in the given order.

    ``row_number() = 1`` lets Spark keep one candidate per key in every task
    before the shuffle, so a key with a third of all rows sends no more than
    one row per task.
    """
    ranked = df.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    )
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def newest_capture(posts: DataFrame) -> DataFrame:
    """The newest capture of each question.

    Copies of one question often share ``creation_date``; later activity and
    then the message id settle such ties the same way on every run.
    """
    return first_per_key(
        posts,
        ["question_id"],
        [
            F.desc_nulls_last("creation_date"),
            F.desc_nulls_last("last_activity_date"),
            F.desc("message_id"),
        ],
    )


def latest_object(posts: DataFrame, hour: Column) -> DataFrame:
    """What an object store holds when each capture overwrites its path.

    A path is one question within one hour; the last arrival (``seq``) stays.
    """
    keyed = posts.withColumn("_hour", hour)
    return first_per_key(keyed, ["_hour", "question_id"], [F.desc("seq")]).drop("_hour")
