"""Record contracts and the fixed values of the post data model."""

from __future__ import annotations

from pyspark.sql import types as T

OWNER = T.StructType(
    [
        T.StructField("account_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("reputation", T.IntegerType()),
        T.StructField("user_type", T.StringType()),
        T.StructField("display_name", T.StringType()),
        T.StructField("profile_image", T.StringType()),
        T.StructField("link", T.StringType()),
    ]
)

# Fixed contract of one post. ``question_id`` is required; Spark readers take
# nullable=False as a hint only, so operators/contract.py enforces it.
POST = T.StructType(
    [
        T.StructField("question_id", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("link", T.StringType()),
        T.StructField("score", T.IntegerType()),
        T.StructField("answer_count", T.IntegerType()),
        T.StructField("view_count", T.IntegerType()),
        T.StructField("is_answered", T.BooleanType()),
        T.StructField("creation_date", T.LongType()),
        T.StructField("last_activity_date", T.LongType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("content_license", T.StringType()),
        T.StructField("owner", OWNER),
    ]
)

# What the stores keep of a delivered post.
STORED = T.StructType(
    [
        T.StructField("message_id", T.StringType()),
        *POST.fields,
        # Order of arrival: when the batch landed, and the row's place in it.
        T.StructField("landed_at", T.TimestampType()),
        T.StructField("position", T.LongType()),
    ]
)

# Push envelope; ``data`` is base64.
ENVELOPE = T.StructType(
    [
        T.StructField(
            "message",
            T.StructType(
                [
                    T.StructField("messageId", T.StringType()),
                    T.StructField("data", T.StringType()),
                ]
            ),
        )
    ]
)

# The four engagement classes.
SENTIMENTS = ["HIGH_ENGAGEMENT", "POSITIVE", "NEUTRAL", "NEGATIVE"]

HOUR_KEYS = ["year", "month", "day", "hour"]


def with_hour_keys(schema: T.StructType) -> T.StructType:
    """Schema plus the four text partition columns of the hour layout.

    Naming them as text keeps their leading zeros on reading, with no need to
    turn partition type inference off for the whole session.
    """
    return T.StructType(
        schema.fields + [T.StructField(key, T.StringType()) for key in HOUR_KEYS]
    )
