"""Column expressions; all of them are built from Spark's own functions."""

from postloom.functions.payload import (
    decode_base64,
    json_quoted,
    json_shape_name,
    json_type_name,
    payload_length,
    payload_preview,
    post_json,
)
from postloom.functions.scoring import filled, percent_change, sentiment
from postloom.functions.text import clean_title, has_text, not_blank_line, title_preview
from postloom.functions.timekeys import (
    epoch_day,
    epoch_seconds,
    epoch_ts,
    hour_keys,
    hour_path,
    object_path,
    utc_now,
)

__all__ = [
    "clean_title",
    "decode_base64",
    "epoch_day",
    "epoch_seconds",
    "epoch_ts",
    "filled",
    "has_text",
    "hour_keys",
    "hour_path",
    "json_quoted",
    "json_shape_name",
    "json_type_name",
    "not_blank_line",
    "object_path",
    "payload_length",
    "payload_preview",
    "percent_change",
    "post_json",
    "sentiment",
    "title_preview",
    "utc_now",
]
