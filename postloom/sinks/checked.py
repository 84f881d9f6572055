"""Quality checks worked out while a batch is written, and merged over batches.

What a check observes is kept as sums that add up: rows, nulls, faulty values. They are
observed by the job that writes the batch, so checking takes no scan of its own, and a
suite's result over any set of batches comes from their small stored sums.
"""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from postloom.operators.quality import Check, check_result
from postloom.sinks.files import Batch, batch_folder
from postloom.sinks.parts import existing

STATE = "measure string, amount bigint"
ROWS = "rows"


def _measure(check: Check) -> tuple[str, Column] | None:
    """Name and sum that a check needs besides the rows; None for others."""
    name = f"{check.name}:{check.column}"
    column = F.col(check.column) if check.column is not None else None
    if check.name in ("not_null", "null_ratio"):
        return f"nulls:{check.column}", F.count_if(column.isNull())
    if check.name in ("length_between", "in_set"):
        bounds = f"{check.shortest}:{check.longest}:{'|'.join(check.allowed)}"
        return f"{name}:{bounds}", check.observed().cast("bigint")
    if check.name in ("row_count", "column_exists"):
        return None
    raise ValueError(f"{check.name} cannot be added up over batches; run it on the stored table")


def _measures(checks: list[Check], columns: list[str]) -> dict[str, Column]:
    """The sums of a suite by name; missing columns have none."""
    found = {ROWS: F.count("*")}
    for check in checks:
        if check.column is None or check.column in columns:
            own = _measure(check)
            if own is not None:
                found[own[0]] = own[1]
        if check.name == "column_exists":
            there = F.count("*") if check.column in columns else F.count_if(F.lit(False))
            found[f"exists:{check.column}"] = there
    return found


def write_checked(
    rows: DataFrame,
    checks: list[Check],
    root: str,
    batch: Batch,
    write: Callable[[DataFrame], None],
) -> None:
    """Write a batch by ``write`` and store the sums of its checks below ``root``.

    ``write`` has to run one job over all rows. A batch that is run again replaces its sums.
    Uniqueness does not add up over batches and is refused.
    """
    measures = _measures(checks, rows.columns)
    names = list(measures)
    seen = Observation()
    write(rows.observe(seen, *(measures[n].alias(f"_{i}") for i, n in enumerate(names))))
    try:
        found = seen.get
    except Py4JJavaError:
        # Of a plan that Spark finds to be empty nothing is observed.
        found = {}
    state = [(name, int(found.get(f"_{i}") or 0)) for i, name in enumerate(names)]
    (
        rows.sparkSession.createDataFrame(state, STATE)
        .coalesce(1)
        .write.mode("overwrite")
        .parquet(batch_folder(root, batch))
    )


def merged_results(
    spark: SparkSession, checks: list[Check], root: str, table: str, run_id: str
) -> DataFrame:
    """The suite's results over all stored batches, as ``quality.run_suite`` gives them."""
    sums = existing(spark, STATE, root).groupBy("measure").agg(F.sum("amount").alias("amount"))
    # One value for each measure of the suite.
    amounts = sums.agg(
        F.map_from_entries(F.collect_list(F.struct("measure", "amount"))).alias("_m")
    )

    def amount(name: str) -> Column:
        return F.try_element_at("_m", F.lit(name))

    total = F.coalesce(amount(ROWS), F.lit(0))
    rows = []
    for check in checks:
        if check.name == "row_count":
            observed = total
        elif check.name == "column_exists":
            # A column counts as there when all rows had it.
            observed = (F.coalesce(amount(f"exists:{check.column}"), F.lit(-1)) == total).cast("int")
        else:
            found = amount(_measure(check)[0])
            observed = found / F.nullif(total, F.lit(0)) if check.name == "null_ratio" else found
        rows.append(check_result(check, table, run_id, observed))
    return amounts.select(F.inline(F.array(*rows)))
