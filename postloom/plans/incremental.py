"""Gold kept up to date batch by batch: only what new captures change is worked out.

The newest capture of each question is kept by day of creation. A batch of captures may
replace some of them, and so adds to some days and takes from others. These days'
figures are counted again from their own rows, and the windows of gold that hold one of
them are written again; every other day keeps its files. The result is that of
``medallion.gold`` over all captures so far.

The changes of a batch are written first, so that a batch which fails half way and
comes again finishes the same work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postloom.functions import epoch_day, has_text
from postloom.operators.newest import newest_capture
from postloom.plans import medallion
from postloom.schema import POST, SENTIMENTS
from postloom.sinks.files import Batch, batch_folder
from postloom.sinks.parts import part_names, read_parts, replace_parts
from postloom.sinks.versions import is_whole

# Days and months of rows without a time are named so.
NO_DAY = "none"

_KIND = {f.name: f.dataType for f in POST.fields}
WINNER = T.StructType(
    [
        T.StructField("question_id", T.LongType()),
        T.StructField("has_text", T.BooleanType()),
        T.StructField("author", T.StringType()),
        *(T.StructField(n, _KIND[n]) for n in ("score", "answer_count")),
        T.StructField("creation_date", T.LongType()),
        T.StructField("last_activity_date", T.LongType()),
        T.StructField("message_id", T.StringType()),
    ]
)
DAILY = T.StructType(
    [
        T.StructField("report_date", T.DateType()),
        T.StructField("sentiment", T.StringType()),
        T.StructField("post_count", T.LongType()),
        T.StructField("avg_score", T.DoubleType()),
        T.StructField("total_score", T.LongType()),
        T.StructField("unique_authors", T.LongType()),
    ]
)
GOLD = T.StructType(
    [
        *DAILY.fields,
        T.StructField("posts_rolling_7d", T.LongType()),
        T.StructField("prev_day_posts", T.LongType()),
        T.StructField("day_over_day_change_pct", T.DoubleType()),
    ]
)


def _day(epoch: str) -> Column:
    return F.coalesce(epoch_day(F.col(epoch)).cast("string"), F.lit(NO_DAY))


def _month(day: str) -> Column:
    return F.substring(F.coalesce(F.col(day).cast("string"), F.lit(NO_DAY)), 1, 7)


def _narrow(captures: DataFrame) -> DataFrame:
    """What gold needs of a capture."""
    return captures.select(
        "question_id",
        F.coalesce(has_text(F.col("title")), F.lit(False)).alias("has_text"),
        F.col("owner.display_name").alias("author"),
        "score",
        "answer_count",
        "creation_date",
        "last_activity_date",
        "message_id",
    )


def changes(captures: DataFrame, root: str) -> DataFrame:
    """Captures of a batch that are now the newest of their question.

    Adds ``part``, the day they belong to, and ``left``, the day whose row they replace
    (null for a new question). The stored captures are looked up by a scan of their few
    narrow columns against the batch's questions; the stored table is not shuffled.
    """
    spark = captures.sparkSession
    fresh = newest_capture(_narrow(captures)).withColumn("_stored", F.lit(False))
    stored = read_parts(spark, f"{root}/winners", WINNER).withColumn("_stored", F.lit(True))
    asked = fresh.select(F.col("question_id").alias("_asked"))
    known = stored.join(asked, F.col("question_id").eqNullSafe(F.col("_asked")), "left_semi")
    both = fresh.withColumn("part", _day("creation_date")).unionByName(known)
    # The same message again is no change, so of equal rows the stored one is taken.
    order = Window.partitionBy("question_id").orderBy(
        F.desc_nulls_last("creation_date"),
        F.desc_nulls_last("last_activity_date"),
        F.desc("message_id"),
        F.desc("_stored"),
    )
    before = F.max(F.when(F.col("_stored"), F.col("part"))).over(
        Window.partitionBy("question_id")
    )
    return (
        both.withColumns({"left": before, "_rank": F.row_number().over(order)})
        .where((F.col("_rank") == 1) & ~F.col("_stored"))
        .drop("_rank", "_stored")
    )


def _daily(winners: DataFrame) -> DataFrame:
    """Daily figures from newest captures."""
    titled = winners.where("has_text").select(
        "creation_date",
        "author",
        F.coalesce("score", F.lit(0)).alias("score_filled"),
        medallion.sentiment(F.col("score"), F.col("answer_count")).alias("sentiment"),
    )
    return medallion.daily(titled).select(*DAILY.fieldNames())


def _spread_months(daily: DataFrame, days: list[str]) -> list[str]:
    """Months with a row of gold that the given days change.

    A row's window holds the six rows before it, so a day changes the next six rows of a
    class after it, also where the day itself has no row any more.
    """
    spark = daily.sparkSession
    marks = spark.createDataFrame(
        [(None if d == NO_DAY else d, s) for d in days for s in SENTIMENTS],
        "day string, sentiment string",
    ).select(F.col("day").cast("date").alias("report_date"), "sentiment", F.lit(0).alias("held"))
    rows = daily.select("report_date", "sentiment", F.lit(1).alias("held")).unionByName(marks)
    # The window over a class sees two rows a calendar day at most.
    order = Window.partitionBy("sentiment").orderBy(F.asc_nulls_first("report_date"), "held")
    counted = rows.withColumn("number", F.sum("held").over(order))
    marked = F.last(F.when(F.col("held") == 0, F.col("number")), ignorenulls=True).over(order)
    touched = counted.withColumn("marked", marked).where(
        (F.col("held") == 1) & (F.col("number") - F.col("marked") <= 7)
    )
    return part_names(touched.select(_month("report_date").alias("part")))


def refresh_gold(captures: DataFrame, root: str, batch: Batch) -> list[str]:
    """Bring the gold table below ``root`` up to date with a batch; the days it changed.

    A batch that comes again under the same number does the work of its first attempt
    once more, with the same result. Captures of one message count once.
    """
    spark = captures.sparkSession
    path = batch_folder(f"{root}/changes", batch)
    if not is_whole(spark, path):
        changes(captures, root).write.mode("overwrite").parquet(path)
    kinds = T.StructType(
        [*WINNER.fields, T.StructField("part", T.StringType()), T.StructField("left", T.StringType())]
    )
    changed = spark.read.schema(kinds).parquet(path)
    moved = changed.select(F.explode(F.array_compact(F.array("part", "left"))).alias("part"))
    days = part_names(moved)
    if not days:
        return []

    winners = f"{root}/winners"
    gone = changed.select(F.col("question_id").alias("_gone"))
    kept = read_parts(spark, winners, WINNER, days).join(
        gone, F.col("question_id").eqNullSafe(F.col("_gone")), "left_anti"
    )
    replace_parts(kept.unionByName(changed.drop("left")), winners, days, "question_id")

    # Figures are kept by month: the touched days anew, the other days as they were.
    months = sorted({d[:7] for d in days})
    named = spark.createDataFrame([(d,) for d in days], "_day string")
    fresh = _daily(read_parts(spark, winners, WINNER, days))
    day = F.coalesce(F.col("report_date").cast("string"), F.lit(NO_DAY))
    others = read_parts(spark, f"{root}/daily", DAILY, months).join(
        named, day == F.col("_day"), "left_anti"
    )
    figures = fresh.withColumn("part", _month("report_date")).unionByName(others)
    replace_parts(figures, f"{root}/daily", months, "report_date", "sentiment")

    # One narrow row for each day and class: the windows run over these alone.
    daily = read_parts(spark, f"{root}/daily", DAILY).drop("part")
    written = sorted({*months, *_spread_months(daily, days)})
    rows = medallion.gold_of(daily).withColumn("part", _month("report_date"))
    rows = rows.where(F.col("part").isin(written))
    replace_parts(rows, f"{root}/gold", written, "report_date", "sentiment")
    return days


def read_gold(spark: SparkSession, root: str, months: list[str] | None = None) -> DataFrame:
    """The gold table, or the rows of some months (``2024-01``)."""
    return read_parts(spark, f"{root}/gold", GOLD, months).drop("part")
