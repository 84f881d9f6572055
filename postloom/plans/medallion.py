"""Bronze, silver and gold, each a function of the layer below."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from postloom.functions import (
    clean_title,
    epoch_day,
    epoch_ts,
    filled,
    has_text,
    percent_change,
    sentiment,
)
from postloom.operators.newest import newest_capture
from postloom.operators.pinning import pin
from postloom.operators.quality import (
    Check,
    column_exists,
    in_set,
    length_between,
    not_null,
    null_ratio,
    row_count,
    unique,
)
from postloom.schema import POST, SENTIMENTS
from postloom.sources.tables import expose_view


def bronze(raw: DataFrame, view: str = "posts_bronze") -> DataFrame:
    """The raw table under its bronze name, uncopied."""
    return expose_view(raw, view)


def silver(posts: DataFrame) -> DataFrame:
    """Newest capture of each question, cleaned and classed.

    The title test follows the de-duplication: a question whose newest capture
    has no title is gone even if an older one had one. It is worked out before,
    so that layers that need no title do not move it.
    """
    titled = pin(posts, "_has_text", has_text(F.col("title")))
    narrow = titled.select(
        "_has_text",
        "question_id",
        "title",
        F.col("owner.display_name").alias("author"),
        "score",
        "answer_count",
        "view_count",
        "link",
        "creation_date",
        "last_activity_date",
        "message_id",
    )
    kept = newest_capture(narrow).filter("_has_text")
    score, answers = F.col("score"), F.col("answer_count")
    return kept.select(
        "question_id",
        clean_title(F.col("title")).alias("title_clean"),
        "author",
        filled(score).alias("score_filled"),
        filled(answers).alias("answer_count_filled"),
        filled(F.col("view_count")).alias("view_count_filled"),
        "link",
        "creation_date",
        epoch_ts(F.col("creation_date")).alias("created_ts"),
        sentiment(score, answers).alias("sentiment"),
    )


def silver_table(silver_rows: DataFrame) -> DataFrame:
    """Silver with the day it is partitioned by."""
    return silver_rows.withColumn("created_date", epoch_day(F.col("creation_date")))


def daily(silver_rows: DataFrame) -> DataFrame:
    """Counts, votes and authors for each day and class."""
    return silver_rows.groupBy(
        epoch_day(F.col("creation_date")).alias("report_date"), "sentiment"
    ).agg(
        F.count("*").alias("post_count"),
        F.avg("score_filled").alias("avg_score"),
        F.sum("score_filled").alias("total_score"),
        F.count_distinct("author").alias("unique_authors"),
    )


def _by_day() -> WindowSpec:
    """Days of one class in order.

    A class has one daily row per calendar day, so no task of a window over
    them gets more than that however many posts there are.
    """
    return Window.partitionBy("sentiment").orderBy(F.asc_nulls_first("report_date"))


def rolling_rows() -> Column:
    """Posts of this row and the six before it."""
    return F.sum("post_count").over(_by_day().rowsBetween(-6, 0))


def rolling_calendar() -> Column:
    """Posts of the seven calendar days that end with this one."""
    by_number = Window.partitionBy("sentiment").orderBy(
        F.unix_date("report_date").asc_nulls_first()
    )
    return F.sum("post_count").over(by_number.rangeBetween(-6, 0))


def previous_count() -> Column:
    """Posts of the previous row of the same class."""
    return F.lag("post_count").over(_by_day())


def gold(silver_rows: DataFrame) -> DataFrame:
    """Daily figures with rolling sum, previous day and change."""
    return gold_of(daily(silver_rows))


def gold_of(daily_rows: DataFrame) -> DataFrame:
    """The same from daily figures."""
    return (
        daily_rows.withColumns(
            {
                "posts_rolling_7d": rolling_rows(),
                "prev_day_posts": previous_count(),
            }
        )
        .withColumn(
            "day_over_day_change_pct",
            percent_change(F.col("post_count"), F.col("prev_day_posts")),
        )
    )


def bronze_suite(
    min_rows: float = 1, max_null_ratio: float = 0.1
) -> list[Check]:
    """Schema, uniqueness, size and null shares of the raw table."""
    return [
        row_count(low=min_rows),
        *[column_exists(field.name) for field in POST.fields],
        unique("question_id"),
        null_ratio("title", max_null_ratio),
        null_ratio("score", max_null_ratio),
        null_ratio("answer_count", max_null_ratio),
        null_ratio("owner", max_null_ratio),
    ]


def silver_suite(shortest: int = 1, longest: int = 150) -> list[Check]:
    """Uniqueness, required values, title lengths and classes of silver."""
    return [
        unique("question_id"),
        not_null("question_id"),
        not_null("title_clean"),
        not_null("sentiment"),
        length_between("title_clean", shortest, longest),
        in_set("sentiment", SENTIMENTS),
    ]
