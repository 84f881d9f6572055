"""Bronze, silver and gold on hand-made rows."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from postloom.functions import clean_title, has_text, percent_change, sentiment
from postloom.plans import medallion, serving
from postloom.schema import POST

DAY = 86400
ROW = "message_id string, " + ", ".join(
    f"{field.name} {field.dataType.simpleString()}" for field in POST.fields
)


def post(message, question, title="t", created=0, active=0, score=0, author="a", **more):
    owner = None if author is None else (1, 1, 1, "registered", author, None, None)
    return (
        message, question, title, more.get("link"), score, more.get("answers", 0), 0,
        False, created, active, ["x"], None, owner,
    )


@pytest.fixture
def frame(spark):
    return lambda *rows: spark.createDataFrame(list(rows), ROW)


@pytest.mark.parametrize(
    ("title", "clean", "texty"),
    [
        (None, "", None),
        ("", "", False),
        ("   ", "", False),
        ("\t", "", False),
        (" ", "", False),
        ("　 ", "", False),
        ("???", "", True),
        ("Zürich", "Z rich", True),
        ("a/b, c", "a b c", True),
        ("a\x0bb", "a b", True),
        ("  C++ & Rust\n\n2 ", "C Rust 2", True),
    ],
)
def test_titles(spark, title, clean, texty):
    row = spark.createDataFrame([(title,)], "t string").select(
        clean_title(F.col("t")), has_text(F.col("t"))
    ).first()
    assert tuple(row) == (clean, texty)


@pytest.mark.parametrize(
    ("score", "answers", "expected"),
    [
        (50, 10, "HIGH_ENGAGEMENT"),
        (50, 9, "POSITIVE"),
        (49, 10, "POSITIVE"),
        (20, 0, "POSITIVE"),
        (19, 0, "NEUTRAL"),
        (0, 0, "NEUTRAL"),
        (-1, 99, "NEGATIVE"),
        (None, None, "NEUTRAL"),
        (60, None, "POSITIVE"),
    ],
)
def test_sentiment(spark, score, answers, expected):
    row = spark.createDataFrame([(score, answers)], "s int, a int").select(
        sentiment(F.col("s"), F.col("a"))
    ).first()
    assert row[0] == expected


@pytest.mark.parametrize(
    ("now", "before", "expected"),
    [(5, 0, None), (5, None, None), (0, 5, -100.0), (3, 2, 50.0), (5, -1, None)],
)
def test_percent_change(spark, now, before, expected):
    row = spark.createDataFrame([(now, before)], "n long, b long").select(
        percent_change(F.col("n"), F.col("b"))
    ).first()
    assert row[0] == expected


def test_dedup_ties_and_order(frame):
    rows = frame(
        post("m1", 1, "old", created=5, active=9),
        post("m2", 1, "new", created=5, active=10),
        post("m3", 2, "dated", created=1),
        post("m4", 2, "undated", created=None, active=99),
        post("m5", 3, "had a title", created=1),
        post("m6", 3, None, created=2),
        post("m7", 4, "same", created=7, active=7),
        post("m8", 4, "same later id", created=7, active=7),
    )
    kept = {row["question_id"]: row["title_clean"] for row in medallion.silver(rows).collect()}
    # Question 3 is gone: its newest capture has no title.
    assert kept == {1: "new", 2: "dated", 4: "same later id"}


def test_silver_columns_and_filling(frame):
    row = medallion.silver(
        frame(post("m1", 1, "a b", created=1763996420, score=None, author=None))
    ).first()
    assert row["score_filled"] == 0 and row["author"] is None
    assert row["created_ts"] == datetime.datetime(2025, 11, 24, 15, 0, 20)
    assert list(row.asDict()) == [
        "question_id", "title_clean", "author", "score_filled",
        "answer_count_filled", "view_count_filled", "link", "creation_date",
        "created_ts", "sentiment",
    ]


def test_silver_is_the_same_for_doubled_input(frame):
    rows = frame(*[post(f"m{i}", i % 7, f"t{i}", created=i % 5, active=i) for i in range(40)])
    once = sorted(map(tuple, medallion.silver(rows).collect()))
    twice = sorted(map(tuple, medallion.silver(rows.union(rows)).collect()))
    assert once == twice


def test_gold_moves_no_title(frame):
    rows = frame(post("m1", 1, "a b"))
    plan = medallion.gold(medallion.silver(rows))._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("Generate")]
    assert "title" not in above and "_has_text" in above
    # The test follows the de-duplication: the filter on it stands above the window.
    assert above.rindex("_has_text") > above.index("Window")


def test_hot_question_is_limited_before_the_shuffle(frame):
    rows = frame(*[post(f"m{i}", 1, "t", created=i) for i in range(200)])
    plan = medallion.silver(rows)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert [r["creation_date"] for r in medallion.silver(rows).collect()] == [199]


def test_gold_windows_over_a_gap(frame):
    days = [0, 1, 2, 12, 13]
    rows = frame(
        *[post(f"m{d}-{i}", d * 100 + i, created=d * DAY) for d in days for i in range(d + 1)],
        post("m-null", 9999, created=None, author=None),
    )
    silver = medallion.silver(rows)
    gold = medallion.gold(silver).orderBy("report_date").collect()
    assert sum(row["post_count"] for row in gold) == silver.count()
    assert gold[0]["report_date"] is None and gold[0]["unique_authors"] == 0
    assert [row["post_count"] for row in gold] == [1, 1, 2, 3, 13, 14]
    assert [row["posts_rolling_7d"] for row in gold] == [1, 2, 4, 7, 20, 34]
    assert [row["prev_day_posts"] for row in gold] == [None, 1, 1, 2, 3, 13]
    assert gold[2]["day_over_day_change_pct"] == 100.0
    calendar = (
        medallion.daily(silver)
        .select("report_date", medallion.rolling_calendar().alias("n"))
        .orderBy("report_date")
        .collect()
    )
    assert [row["n"] for row in calendar] == [1, 1, 3, 6, 13, 27]


def test_trends(frame):
    rows = frame(
        post("m1", 1, created=0, score=30),
        post("m2", 2, created=0, score=-3),
        post("m3", 3, created=DAY, score=30),
    )
    gold = medallion.gold(medallion.silver(rows))
    wide = {r["report_date"].day: r.asDict() for r in serving.trend_wide(gold).collect()}
    assert wide[1]["POSITIVE"] == 1 and wide[1]["NEGATIVE"] == 1
    assert wide[2]["POSITIVE"] == 1 and wide[2]["NEGATIVE"] is None
    day = datetime.date(1970, 1, 2)
    chosen = serving.with_sentiments(serving.date_range(gold, day, day), ["POSITIVE"])
    assert serving.trend_long(chosen).collect()[0]["post_count"] == 1


def test_bronze_is_a_view(frame, spark):
    medallion.bronze(frame(post("m1", 1)), "bronze_view_test")
    assert spark.table("bronze_view_test").count() == 1
