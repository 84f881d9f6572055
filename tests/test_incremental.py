"""Gold kept up to date by batches, and distinct counts that merge."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from postloom.operators import distinct
from postloom.plans import incremental, medallion
from postloom.sinks.files import Batch
from postloom.sinks.parts import read_parts

DAY = 86_400
CAPTURES = (
    "question_id long, title string, owner struct<display_name: string>, score int, "
    "answer_count int, view_count int, link string, creation_date long, "
    "last_activity_date long, message_id string"
)


def _capture(n, question, day, score=0, title="t", author="a", activity=None):
    created = None if day is None else 1_704_067_200 + day * DAY
    return (question, title, (author,), score, 10, 0, "l", created, activity or created, f"m{n:03d}")


def _sorted(frame):
    rows = [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in frame.collect()]
    return sorted(rows, key=str)


BATCHES = [
    # Ten days with gaps, two classes, a null time, a null question.
    [_capture(i, i, d, 30 if i % 2 else 0, author=f"a{i % 3}") for i, d in enumerate([0, 0, 1, 2, 4, 5, 8, 9, 10, 12, 40])]
    + [_capture(50, 50, None), _capture(51, None, 3)],
    # A question moves to another day, another changes class, one loses its title.
    [_capture(100, 2, 20, 0), _capture(101, 4, 4, 60, activity=2_000_000_000), _capture(102, 5, 6, title=" \t")],
    # An older capture and a repeated message change nothing.
    [_capture(60, 2, 1, 0), _capture(100, 2, 20, 0)],
    # A day in the middle appears, the null ones change.
    [_capture(200, 70, 7, 30), _capture(201, 50, 11), _capture(202, None, 3, 99, activity=2_000_000_000)],
]


def test_equals_gold_after_each_batch(spark, scratch):
    seen = []
    for number, rows in enumerate(BATCHES):
        batch = spark.createDataFrame(rows, CAPTURES)
        days = incremental.refresh_gold(batch, scratch, Batch("run", number))
        seen += rows
        whole = spark.createDataFrame(seen, CAPTURES)
        expected = medallion.gold(medallion.silver(whole)).select(*incremental.GOLD.fieldNames())
        found = incremental.read_gold(spark, scratch).select(*incremental.GOLD.fieldNames())
        assert _sorted(found) == _sorted(expected), number
        assert (days == []) == (number == 2)
    # Days that no batch touched again keep the files of the first one.
    winners = read_parts(spark, f"{scratch}/winners", incremental.WINNER, ["2024-01-10"])
    assert all("version=1/" in f for f in winners.inputFiles()) and winners.inputFiles()


def test_a_batch_that_dies_finishes_its_work_later(spark, scratch, monkeypatch):
    first, second = (spark.createDataFrame(r, CAPTURES) for r in BATCHES[:2])
    incremental.refresh_gold(first, scratch, Batch("run", 0))
    whole, calls = incremental.replace_parts, []

    def dying(*args):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return whole(*args)

    monkeypatch.setattr(incremental, "replace_parts", dying)
    with pytest.raises(RuntimeError, match="lost"):
        incremental.refresh_gold(second, scratch, Batch("run", 1))
    monkeypatch.setattr(incremental, "replace_parts", whole)
    # The newest captures are stored already, the figures are not.
    for _ in range(2):
        assert incremental.refresh_gold(second, scratch, Batch("run", 1))
        both = spark.createDataFrame(BATCHES[0] + BATCHES[1], CAPTURES)
        expected = medallion.gold(medallion.silver(both)).select(*incremental.GOLD.fieldNames())
        found = incremental.read_gold(spark, scratch).select(*incremental.GOLD.fieldNames())
        assert _sorted(found) == _sorted(expected)


def test_windows_reach_into_later_months_only_as_far_as_six_rows(spark):
    days = [datetime.date(2024, 1, 28) + datetime.timedelta(days=i) for i in range(60)]
    daily = spark.createDataFrame([(d, "NEUTRAL") for d in days], "report_date date, sentiment string")
    assert incremental._spread_months(daily, ["2024-01-28"]) == ["2024-01", "2024-02"]
    assert incremental._spread_months(daily, ["2024-02-10"]) == ["2024-02"]
    # Days with few rows: the next six rows may be months away.
    rare = spark.createDataFrame([(d, "NEUTRAL") for d in days[::15]], "report_date date, sentiment string")
    assert incremental._spread_months(rare, ["2024-01-01"]) == ["2024-01", "2024-02", "2024-03"]
    assert incremental._spread_months(daily, [incremental.NO_DAY]) == ["2024-01", "2024-02"]


def test_only_touched_days_are_read(spark, scratch):
    first = spark.createDataFrame(BATCHES[0], CAPTURES)
    incremental.refresh_gold(first, scratch, Batch("run", 0))
    late = spark.createDataFrame([_capture(300, 80, 40, 30)], CAPTURES)
    assert incremental.refresh_gold(late, scratch, Batch("run", 1)) == ["2024-02-10"]
    gold = incremental.read_gold(spark, scratch, ["2024-01"])
    assert all("version=1/" in f for f in gold.inputFiles()) and gold.inputFiles()


def test_numbers_have_no_gaps_and_grow(spark):
    names = spark.range(5_000).selectExpr("concat('n', id % 3000) AS author")
    first = distinct.new_numbers(names, "author")
    numbers = sorted(r["number"] for r in first.collect())
    assert numbers == list(range(1, 3_001))
    more = spark.createDataFrame([("n1",), ("x",), ("y",), (None,), ("x",)], "author string")
    new = distinct.new_numbers(more, "author", first)
    assert sorted((r["author"], r["number"]) for r in new.collect()) in (
        [("x", 3_001), ("y", 3_002)],
        [("x", 3_002), ("y", 3_001)],
    )
    empty = spark.createDataFrame([], "author string")
    assert distinct.new_numbers(empty, "author").collect() == []


def test_counts_of_ranges_equal_count_distinct(spark):
    day = F.date_add(F.lit(datetime.date(2024, 1, 1)), (F.col("id") % 20).cast("int"))
    rows = spark.range(60_000).select(
        day.alias("day"),
        F.when(F.col("id") % 2 == 0, "even").otherwise("odd").alias("kind"),
        F.when(F.col("id") % 97 != 0, F.concat(F.lit("a"), F.col("id") * 7919 % 50_000)).alias("author"),
    )
    dictionary = distinct.new_numbers(rows, "author")
    maps = distinct.bitmaps(rows, ["day", "kind"], "author", dictionary)
    # More than one bitmap row a group, and a group whose numbers lie in the second.
    assert maps.select("bucket").distinct().count() == 2
    ranges = spark.createDataFrame(
        [
            (datetime.date(2024, 1, 1), datetime.date(2024, 1, 20)),
            (datetime.date(2024, 1, 3), datetime.date(2024, 1, 9)),
            (datetime.date(2024, 1, 5), datetime.date(2024, 1, 5)),
            (datetime.date(2023, 1, 5), datetime.date(2023, 2, 5)),
        ],
        "first_day date, last_day date",
    )
    for keys in ([], ["kind"]):
        found = distinct.count_by_range(maps, ranges, "day", *keys)
        expected = (
            ranges.join(rows, F.col("day").between(F.col("first_day"), F.col("last_day")))
            .groupBy("first_day", "last_day", *keys)
            .agg(F.count_distinct("author").alias("values"))
        )
        assert _sorted(found) == _sorted(expected)
    assert distinct.count_by_range(maps, ranges, "day").count() == 3
