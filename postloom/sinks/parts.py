"""Tables whose parts are replaced one by one (copy on write).

Rows lie under ``rows/part=<value>/version=<number>``. A write brings some parts in
full; each gets a new version, and a log, dealt by part as well, tells the version that
holds each part now. Parts that a write does not bring are neither read nor written.
Readers follow the log of finished versions, so a write that fails changes nothing.
There is one writer at a time; a second one is found out before it is published.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postloom.sinks.files import spread
from postloom.sinks.versions import (
    claim_version,
    done_versions,
    failed_versions,
    forget_marks,
    publish_version,
    remove,
)

_LOG = "part string, version bigint, held bigint"


def _empty(spark: SparkSession, schema: str | T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def existing(
    spark: SparkSession, schema: str | T.StructType, base: str, *paths: str
) -> DataFrame:
    """Rows of the folders (globs allowed) that there are, with partition columns."""
    frames = None
    for path in paths or (base,):
        try:
            rows = spark.read.option("basePath", base).schema(schema).parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        frames = rows if frames is None else frames.unionByName(rows)
    return _empty(spark, schema) if frames is None else frames


def current_parts(
    spark: SparkSession, root: str, parts: list[str] | None = None
) -> DataFrame:
    """part and version of all parts, or of the given ones, that hold rows.

    Only the log folders of the given parts are listed.
    """
    done = done_versions(spark, root)
    if not done:
        return _empty(spark, "part string, version bigint")
    base = f"{root}/parts"
    wanted = [base] if parts is None else [f"{base}/part={{{','.join(parts)}}}"]
    # Versions come one after another; the few that were claimed and never done are left out.
    log = existing(spark, _LOG, base, *wanted).where(F.col("version") <= done[-1])
    failed = [n for n in failed_versions(spark, root) if n < done[-1]]
    if failed:
        log = log.where(~F.col("version").isin(failed))
    newest = F.row_number().over(Window.partitionBy("part").orderBy(F.desc("version")))
    return (
        log.withColumn("newest", newest)
        .where((F.col("newest") == 1) & (F.col("held") > 0))
        .select("part", "version")
    )


def read_parts(
    spark: SparkSession, root: str, schema: T.StructType, parts: list[str] | None = None
) -> DataFrame:
    """Current rows of the table, or of some parts, with the column ``part``.

    With ``parts`` no file of another part is listed or opened; without, the log is
    joined to the partitions, which prunes the old versions of each part.
    """
    whole = T.StructType(
        [
            *schema.fields,
            T.StructField("part", T.StringType()),
            T.StructField("version", T.LongType()),
        ]
    )
    base = f"{root}/rows"
    current = current_parts(spark, root, parts)
    if parts is None:
        rows = existing(spark, whole, base)
        return rows.join(current, ["part", "version"], "left_semi").drop("version")
    # One short path for each part that the caller named comes to the driver.
    folders = [f"{base}/part={r['part']}/version={r['version']}" for r in current.collect()]
    if not folders:
        return _empty(spark, whole).drop("version")
    rows = spark.read.option("basePath", base).schema(whole).parquet(*folders)
    return rows.drop("version")


def part_names(rows: DataFrame) -> list[str]:
    """The distinct parts of some rows; at most one short name a part comes to the driver."""
    return sorted(row[0] for row in rows.select("part").distinct().collect())


def replace_parts(rows: DataFrame, root: str, parts: list[str], *order: str) -> int:
    """Put ``rows`` in the place of ``parts``, and return the new version's number.

    ``rows`` has a column ``part`` with no other value than ``parts``; a part without
    rows is empty from then on. Files are sorted by ``order``.
    """
    spark = rows.sparkSession
    before = done_versions(spark, root)
    number = claim_version(spark, root)
    numbered = rows.withColumn("version", F.lit(number).cast("bigint"))
    (
        spread(numbered, "part")
        .sortWithinPartitions("part", *order)
        .write.mode("append")
        .partitionBy("part", "version")
        .parquet(f"{root}/rows")
    )
    written = existing(
        spark,
        "part string, version bigint",
        f"{root}/rows",
        f"{root}/rows/part={{{','.join(parts)}}}/version={number}",
    )
    held = written.groupBy("part").agg(F.count("*").alias("held"))
    named = spark.createDataFrame([(p,) for p in parts], "part string")
    log = named.join(held, "part", "left").select(
        "part",
        F.lit(number).cast("bigint").alias("version"),
        F.coalesce("held", F.lit(0)).alias("held"),
    )
    # One small file for each part: the log of a part is all that is read to find it.
    (
        log.repartition("part")
        .write.mode("append")
        .partitionBy("part")
        .parquet(f"{root}/parts")
    )
    if done_versions(spark, root) != before:
        raise RuntimeError(f"another writer has published a version of {root}")
    publish_version(spark, root, number)
    return number


def drop_old_parts(spark: SparkSession, root: str) -> int:
    """Remove rows that newer versions of their part have replaced; the number of folders.

    To be run while nobody reads an older version. Marks of old versions go too.
    """
    base = f"{root}/rows"
    done = done_versions(spark, root)
    if not done:
        return 0
    there = existing(spark, "part string, version bigint", base).where(
        F.col("version") <= done[-1]
    )
    old = there.distinct().join(current_parts(spark, root), ["part", "version"], "left_anti")
    gone = 0
    for row in old.toLocalIterator():
        remove(spark, f"{base}/part={row['part']}/version={row['version']}")
        gone += 1
    forget_marks(spark, root)
    return gone
