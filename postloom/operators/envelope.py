"""Opening push envelopes: JSON around a base64 payload."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.functions import decode_base64
from postloom.operators.pinning import pin
from postloom.schema import ENVELOPE


def open_envelopes(df: DataFrame, value: str = "value") -> DataFrame:
    """Add ``status``, ``message_id`` and ``payload`` (bytes).

    Status is "no_message" (no envelope, or one without a message), "no_data"
    (data missing or empty), or "ok". Data that is not base64 keeps "ok" and
    has a null payload, since it fails at decoding and not at the guards.
    """
    opened = pin(df, "_message", F.from_json(value, ENVELOPE)["message"])
    data = F.col("_message.data")
    return opened.select(
        "*",
        F.when(F.col("_message").isNull(), "no_message")
        .when(data.isNull() | (data == ""), "no_data")
        .otherwise("ok")
        .alias("status"),
        F.col("_message.messageId").alias("message_id"),
        decode_base64(F.nullif(data, F.lit(""))).alias("payload"),
    ).drop("_message")
