"""Message payloads: base64, JSON text and JSON types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def decode_base64(data: Column) -> Column:
    """Bytes of base64 text; null where the text is not base64."""
    return F.try_to_binary(data, F.lit("base64"))


def payload_length(payload: Column) -> Column:
    """Number of bytes."""
    return F.octet_length(payload)


def payload_preview(payload: Column, width: int = 10) -> Column:
    """Lower-case hex of the first ``width`` bytes, for logs."""
    return F.lower(F.hex(F.substring(payload, 1, width)))


def post_json(record: Column) -> Column:
    """JSON text of a struct with null fields and non-ASCII letters kept."""
    return F.to_json(record, {"ignoreNullFields": "false"})


def json_quoted(text: Column) -> Column:
    """A string as a JSON literal; null becomes the JSON null."""
    wrapped = F.to_json(F.array(text), {"ignoreNullFields": "false"})
    return F.substring(wrapped, F.lit(2), F.length(wrapped) - 2)


def json_type_name(value: Column) -> Column:
    """Short type name of a VARIANT value; a missing value counts as null.

    VARIANT holds integers beyond 64 bits as decimals of scale 0.
    """
    return json_shape_name(F.schema_of_variant(value))


def json_shape_name(shape: Column) -> Column:
    """Short type name of a schema as ``schema_of_variant`` gives it; null for no value."""
    return (
        F.when(shape.isNull() | (shape == "VOID"), "NoneType")
        .when(shape.rlike(r"^(BIGINT|DECIMAL\((19|[23][0-9]),0\))$"), "int")
        .when(shape == "STRING", "str")
        .when(shape == "BOOLEAN", "bool")
        .when(shape.startswith("ARRAY"), "list")
        .when(shape.startswith("OBJECT"), "dict")
        .otherwise("float")
    )
