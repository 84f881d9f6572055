"""A quality checkpoint as one operation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from postloom.operators.quality import Check, run_suite
from postloom.sinks.files import store_results
from postloom.sources.tables import latest_batch


def run_checkpoint(
    spark: SparkSession,
    table: str,
    checks: list[Check],
    run_id: str,
    results: str,
    batch: str | None = "batch_id",
) -> DataFrame:
    """Run a suite on the latest batch of a named table and store the result.

    ``batch`` names the column of batches; None checks the whole table. The results
    of one run and table replace those of an earlier attempt at them. Returns them
    as stored below ``results``.
    """
    rows = spark.table(table)
    if batch is not None:
        rows = latest_batch(rows, batch)
    found = run_suite(rows, checks, table, run_id)
    store_results(found, results)
    stored = spark.read.schema(found.schema).parquet(results)
    return stored.where((stored["run_id"] == run_id) & (stored["table_name"] == table))
