"""Objects that later deliveries overwrite, one for each question and hour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postloom.functions.timekeys import epoch_seconds, hour_keys
from postloom.operators.newest import first_per_key
from postloom.sinks.parts import part_names, read_parts, replace_parts

ARRIVAL = ("landed_at", "position")


def hour_part(epoch: Column) -> Column:
    """The hour of an object as the name of a part, such as ``2024-01-15-08``."""
    return F.concat_ws("-", *hour_keys(epoch).values())


def upsert_objects(
    posts: DataFrame, root: str, arrival: tuple[str, ...] = ARRIVAL, epoch: str = "creation_date"
) -> list[str]:
    """Merge a batch of posts into the objects of the hours it touches.

    Of each question and hour the row that arrived last stays, by the columns
    ``arrival``; that may be the stored one. Only the touched hours are read and written
    again. A batch merged twice changes nothing. Posts without a question or an hour
    have no object and are left out. Returns the hours; a batch should hold few enough to
    name them (a bounded micro-batch does).
    """
    timed = posts.where(epoch_seconds(F.col(epoch)).isNotNull() & F.col("question_id").isNotNull())
    fresh = timed.withColumn("part", hour_part(F.col(epoch)))
    spark, hours = posts.sparkSession, part_names(fresh)
    if not hours:
        return []
    schema = T.StructType([f for f in fresh.schema.fields if f.name != "part"])
    stored = read_parts(spark, root, schema, hours)
    # Between equal arrivals the stored row wins, as it does when a batch comes again.
    both = fresh.withColumn("_stored", F.lit(0)).unionByName(stored.withColumn("_stored", F.lit(1)))
    order = [*(F.desc(c) for c in arrival), F.desc("_stored")]
    kept = first_per_key(both, ["part", "question_id"], order).drop("_stored")
    replace_parts(kept, root, hours, "question_id")
    return hours


def read_objects(
    spark: SparkSession, root: str, schema: T.StructType, hours: list[str] | None = None
) -> DataFrame:
    """The objects of all hours, or of the named ones, with the column ``part``."""
    return read_parts(spark, root, schema, hours)
