"""Choosing posts by votes, time and tags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Sort names and the columns they stand for.
SORT_COLUMNS = {
    "votes": "score",
    "activity": "last_activity_date",
    "creation": "creation_date",
}


def top_posts(
    posts: DataFrame,
    sort: str = "votes",
    order: str = "desc",
    tagged: str | None = None,
    pagesize: int = 100,
) -> DataFrame:
    """The first ``pagesize`` questions by the given sort, ties by id.

    Sort and limit together keep ``pagesize`` rows per task and merge those.
    """
    column = SORT_COLUMNS[sort]
    if order not in ("asc", "desc"):
        raise ValueError("order is 'asc' or 'desc'")
    direction = F.desc_nulls_last(column) if order == "desc" else F.asc_nulls_first(column)
    if tagged is not None:
        posts = posts.filter(F.array_contains("tags", tagged))
    return posts.orderBy(direction, F.asc("question_id")).limit(pagesize)


def filter_posts(
    posts: DataFrame, min_votes: int | None = None, tagged: str | None = None
) -> DataFrame:
    """Posts with enough votes and the tag."""
    if min_votes is not None:
        posts = posts.filter(F.col("score") >= min_votes)
    if tagged is not None:
        posts = posts.filter(F.array_contains("tags", tagged))
    return posts


def first_messages(messages: DataFrame, max_messages: int) -> DataFrame:
    """The first messages in arrival order (``seq``)."""
    return messages.orderBy("seq").limit(max_messages)
