"""Raw messages against the post contract."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from postloom.operators import contract


def checked_one(spark, text, missing_id="zero"):
    rows = spark.createDataFrame([("m1", text)], "message_id string, value string")
    return contract.check_contract(rows, missing_id=missing_id).first()


@pytest.mark.parametrize(
    ("text", "reason", "fields"),
    [
        ("not json", "bad_json", ""),
        ('{"question_id": 1', "bad_json", ""),
        ("[1, 2]", "not_object", ""),
        ("5", "not_object", ""),
        ('{"x": 1}', None, ""),
        ('{"question_id": null}', "null_id", ""),
        ('{"question_id": "7"}', "bad_type", "question_id"),
        ('{"question_id": 99999999999999999999}', "bad_type", "question_id"),
        ('{"question_id": 1, "score": 3000000000}', "bad_type", "score"),
        ('{"question_id": 1, "score": 2147483647}', None, ""),
        ('{"question_id": 1, "score": -2147483649}', "bad_type", "score"),
        ('{"question_id": 1, "score": "x"}', "bad_type", "score"),
        ('{"question_id": 1, "score": 5.5}', "bad_type", "score"),
        ('{"question_id": 1, "score": true}', "bad_type", "score"),
        ('{"question_id": 1, "is_answered": 1}', "bad_type", "is_answered"),
        ('{"question_id": 1, "title": 5}', "bad_type", "title"),
        ('{"question_id": 1, "tags": [1]}', "bad_type", "tags"),
        ('{"question_id": 1, "tags": ["a", null]}', "bad_type", "tags"),
        ('{"question_id": 1, "tags": [null]}', "bad_type", "tags"),
        ('{"question_id": 1, "tags": "a"}', "bad_type", "tags"),
        ('{"question_id": 1, "tags": []}', None, ""),
        ('{"question_id": 1, "tags": null}', None, ""),
        ('{"question_id": 1, "owner": "x"}', "bad_type", "owner"),
        ('{"question_id": 1, "owner": [1]}', "bad_type", "owner"),
        ('{"question_id": 1, "owner": {"user_id": "a"}}', "bad_type", "owner.user_id"),
        (
            '{"question_id": 1, "title": 5, "owner": {"link": 2}}',
            "bad_type",
            "title, owner.link",
        ),
        ('{"question_id": 1, "extra": {"deep": [1]}}', None, ""),
    ],
)
def test_reason(spark, text, reason, fields):
    row = checked_one(spark, text)
    assert (row["reason"], row["bad_fields"] or "") == (reason, fields)


@pytest.mark.parametrize(
    ("owner", "expected"),
    [
        (None, None),
        ("null", None),
        ("{}", None),
        ("[]", None),
        ('""', None),
        ("false", None),
        ("0", None),
        ('{"x": 1}', {"user_id": None, "display_name": None}),
        ('{"user_id": 4}', {"user_id": 4, "display_name": None}),
    ],
)
def test_owner(spark, owner, expected):
    text = '{"question_id": 1' + (f', "owner": {owner}' if owner else "") + "}"
    row = checked_one(spark, text)
    assert row["reason"] is None
    found = row["post"]["owner"]
    if expected is None:
        assert found is None
    else:
        assert {name: found[name] for name in expected} == expected


def test_missing_id_policies(spark):
    text = '{"link": "l"}'
    assert checked_one(spark, text)["post"]["question_id"] == 0
    assert checked_one(spark, text, "reject")["reason"] == "missing_id"
    null_id = checked_one(spark, '{"question_id": null}', "reject")
    assert null_id["reason"] == "null_id"
    with pytest.raises(ValueError):
        checked_one(spark, text, "guess")


def test_broken_message_is_published_and_leaves_silver(spark):
    """Without id and title a message is valid as id 0; silver drops it."""
    from postloom.plans.medallion import silver

    rows = spark.createDataFrame(
        [("m1", '{"score": 3}'), ("m2", '{"question_id": 5, "title": "t"}')],
        "message_id string, value string",
    )
    valid = contract.valid_posts(contract.check_contract(rows))
    assert valid.count() == 2
    kept = silver(valid.select("message_id", "post.*")).collect()
    assert [row["question_id"] for row in kept] == [5]


def test_routes_are_complete_and_texts_whole(spark):
    long_title = "é" * 50_000
    texts = [
        json.dumps({"question_id": 1, "title": long_title}, ensure_ascii=False),
        "x" * 10_000,
        '{"question_id": 2, "score": "no"}',
    ]
    rows = spark.createDataFrame(
        [(f"m{i}", text) for i, text in enumerate(texts)],
        "message_id string, value string",
    )
    checked = contract.check_contract(rows)
    main = contract.publishable(checked, source="s").collect()
    assert [json.loads(row["value"])["title"] for row in main] == [long_title]
    assert json.loads(main[0]["value"])["owner"] is None
    assert main[0]["attributes"] == {
        "encoding": "json",
        "schema_version": "v1",
        "source": "s",
    }
    dead = contract.dead_letters(checked, timestamp=F.lit("now")).orderBy("message_id")
    assert [(r["raw"], r["error_reason"]) for r in dead.collect()] == [
        (texts[1], "bad_json"),
        (texts[2], "bad_type: score"),
    ]
    stamped = contract.dead_letters(checked).first()["timestamp"]
    assert len(stamped) == 26 and stamped[10] == "T"


def test_text_is_parsed_once(spark):
    rows = spark.createDataFrame([("m1", "{}")], "message_id string, value string")
    valid = contract.valid_posts(contract.check_contract(rows))
    plan = valid._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson") == 1
