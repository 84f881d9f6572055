"""Data-quality checks, run as Spark aggregations.

A suite is a list of checks; its result is one row per check, with what was
observed, the bounds it had to keep, and whether it did.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """One check: what is observed, on which column, within which bounds."""

    name: str
    column: str | None = None
    low: float | None = None
    high: float | None = None
    allowed: tuple[str, ...] = ()
    shortest: int = 0
    longest: int = 0

    def observed(self) -> Column:
        """Aggregate over the whole table, as a double."""
        if self.name == "row_count":
            metric = F.count("*")
        elif self.name == "not_null":
            metric = F.count_if(F.col(self.column).isNull())
        elif self.name == "null_ratio":
            metric = F.avg(F.col(self.column).isNull().cast("int"))
        elif self.name == "length_between":
            length = F.length(self.column)
            metric = F.count_if((length < self.shortest) | (length > self.longest))
        elif self.name == "in_set":
            metric = F.count_if(~F.col(self.column).isin(*self.allowed))
        else:
            raise ValueError(f"no such check: {self.name}")
        return metric.cast("double")


def row_count(low: float | None = None, high: float | None = None) -> Check:
    """Number of rows lies within the bounds."""
    return Check("row_count", None, low, high)


def column_exists(column: str) -> Check:
    """The table has the column; observed is 1 or 0."""
    return Check("column_exists", column, 1, 1)


def not_null(column: str) -> Check:
    """No nulls; observed is their number."""
    return Check("not_null", column, None, 0)


def null_ratio(column: str, high: float) -> Check:
    """Share of nulls is at most ``high``."""
    return Check("null_ratio", column, None, high)


def unique(column: str) -> Check:
    """No value occurs twice; observed is the number of values that do."""
    return Check("unique", column, None, 0)


def length_between(column: str, shortest: int, longest: int) -> Check:
    """Every text is that long; observed is the number that are not."""
    return Check(
        "length_between", column, None, 0, shortest=shortest, longest=longest
    )


def in_set(column: str, allowed: list[str]) -> Check:
    """Every value is an allowed one; observed is the number that are not."""
    return Check("in_set", column, None, 0, allowed=tuple(allowed))


def duplicated(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, and how often; nulls do not count."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("copies"))
        .filter(F.col("copies") > 1)
    )


def check_result(check: Check, table: str, run_id: str, observed: Column) -> Column:
    """One row of a suite's result."""
    observed = observed.cast("double")
    kept = observed.isNotNull()
    if check.low is not None:
        kept = kept & (observed >= check.low)
    if check.high is not None:
        kept = kept & (observed <= check.high)
    return F.struct(
        F.lit(run_id).alias("run_id"),
        F.lit(table).alias("table_name"),
        F.lit(check.name).alias("check_name"),
        F.lit(check.column).cast("string").alias("column_name"),
        observed.alias("observed"),
        F.lit(check.low).cast("double").alias("threshold_low"),
        F.lit(check.high).cast("double").alias("threshold_high"),
        kept.alias("passed"),
    )


def run_suite(
    df: DataFrame, checks: list[Check], table: str, run_id: str
) -> DataFrame:
    """One row per check.

    All counts and ratios come out of a single aggregation that shuffles one
    row per task. Each uniqueness check adds a scan of its own column, which
    is counted per task before the shuffle; folding it into the first pass
    would drag every other metric through that shuffle. A check on a column
    the table lacks fails with nothing observed.
    """
    columns = set(df.columns)
    aggregates: dict[int, Column] = {}
    parts: list[DataFrame] = []
    for number, check in enumerate(checks):
        if check.column is not None and check.column not in columns:
            continue
        if check.name == "unique":
            found = duplicated(df, check.column).agg(F.count("*").alias("_dups"))
            parts.append(
                found.select(check_result(check, table, run_id, F.col("_dups")).alias("r"))
            )
        elif check.name != "column_exists":
            aggregates[number] = check.observed().alias(f"_m{number}")
    # The count keeps the frame at one row when no other metric is asked for.
    totals = df.agg(F.count("*").alias("_all"), *aggregates.values())
    rows = []
    for number, check in enumerate(checks):
        if number in aggregates:
            rows.append(check_result(check, table, run_id, F.col(f"_m{number}")))
        elif check.name == "column_exists":
            rows.append(
                check_result(check, table, run_id, F.lit(int(check.column in columns)))
            )
        elif check.column not in columns:
            rows.append(check_result(check, table, run_id, F.lit(None)))
    if rows:
        parts.append(totals.select(F.explode(F.array(*rows)).alias("r")))
    return reduce(DataFrame.unionByName, parts).select("r.*")
