"""Checking raw JSON messages against the post contract.

Faulty rows never fail a job: each gets a reason and goes to the dead letters.
The text is parsed once, to VARIANT, because VARIANT tells a missing key from
a null one and a number from a text that looks like one; ``from_json`` does
neither.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postloom.functions import post_json, utc_now
from postloom.operators.pinning import pin
from postloom.schema import OWNER, POST

# JSON texts of owners that count as absent.
ABSENT_OWNERS = ["null", "false", "0", '""', "[]", "{}"]

_DOC = "_doc"
_SHAPES = "_shapes"
_CAST = "_cast"
_BAD = "_bad"


def _at(path: str, dtype: str) -> Column:
    return F.try_variant_get(F.col(_DOC), f"$.{path}", dtype)


def _leaves() -> dict[str, T.DataType]:
    """Type of every field by path, the owner's own fields included."""
    paths = {field.name: field.dataType for field in POST.fields}
    return paths | {f"owner.{field.name}": field.dataType for field in OWNER.fields}


def _all_shapes() -> Column:
    """Type name of every field; null where the document lacks it."""
    return F.struct(
        *[
            F.schema_of_variant(_at(path, "variant")).alias(path.replace(".", "_"))
            for path in _leaves()
        ]
    )


def _shape(path: str) -> Column:
    return F.col(_SHAPES)[path.replace(".", "_")]


def _cast() -> Column:
    """The contract's fields of a document, each null where it has another type.

    The document is cast at once: a call for each field looks its key up anew, and so many
    calls in a row make a method that Java's compiler leaves to the interpreter.
    """
    return F.try_variant_get(F.col(_DOC), "$", POST.simpleString())


def _is_object() -> Column:
    """True for a document with keys of its own.

    Any contract field shows that; the shape of a whole document is costly
    and asked for only when it has none of them.
    """
    some_field = F.coalesce(*[_shape(field.name) for field in POST.fields])
    return some_field.isNotNull() | F.schema_of_variant(_DOC).startswith("OBJECT<")


def _has_owner() -> Column:
    """True for an owner with at least one key."""
    shape = _shape("owner")
    return shape.startswith("OBJECT<") & (shape != "OBJECT<>")


def _misfit(path: str, dtype: T.DataType) -> Column:
    """True where a value is present, not null, and of the wrong type.

    Null for a field that is not there.
    """
    shape, value = _shape(path), F.col(f"{_CAST}.{path}")
    if isinstance(dtype, T.LongType):
        return ~shape.isin("VOID", "BIGINT")
    if isinstance(dtype, T.IntegerType):
        return ~shape.isin("VOID", "BIGINT") | ((shape == "BIGINT") & value.isNull())
    if isinstance(dtype, T.BooleanType):
        return ~shape.isin("VOID", "BOOLEAN")
    if isinstance(dtype, T.StringType):
        return ~shape.isin("VOID", "STRING")
    if isinstance(dtype, T.ArrayType):
        # A null element does not show in the shape of an array of strings. A
        # sort puts it first, and unlike a lambda keeps to generated code.
        items = F.sort_array(value)
        return ~shape.isin("VOID", "ARRAY<STRING>", "ARRAY<VOID>") | (
            (F.size(items) > 0) & F.get(items, F.lit(0)).isNull()
        )
    return (
        (shape != "VOID")
        & ~shape.startswith("OBJECT<")
        & ~F.to_json(_at(path, "variant")).isin(ABSENT_OWNERS)
    )


def _bad_fields(paths: list[str], before: Column | None = None) -> Column:
    """Names of the misfits among ``paths``, after those ``before``; "" when there are none.

    ``concat_ws`` leaves out nulls within generated code, which the lambda of
    an array filter would not.
    """
    leaves = _leaves()
    misfits = [F.when(_misfit(path, leaves[path]), path) for path in paths]
    if before is not None:
        misfits.insert(0, F.nullif(before, F.lit("")))
    return F.concat_ws(", ", *misfits)


def _projected() -> Column:
    """The contract's fields of a document; other keys are left behind."""
    fields = []
    for field in POST.fields:
        value = F.col(_CAST)[field.name]
        if field.name == "question_id":
            value = F.coalesce(value, F.lit(0))
        elif field.name == "owner":
            value = F.when(_has_owner(), value)
        fields.append(value.alias(field.name))
    return F.struct(*fields)


def check_contract(
    df: DataFrame, value: str = "value", missing_id: str = "zero"
) -> DataFrame:
    """Add ``reason`` (null when valid), ``bad_fields`` and ``post``.

    ``missing_id`` says what a record without ``question_id`` means: "zero"
    gives it id 0, "reject" makes it a fault. An explicit null is always one.
    ``post`` holds the contract's fields and is meaningful for valid rows.
    """
    if missing_id not in ("zero", "reject"):
        raise ValueError("missing_id is 'zero' or 'reject'")
    parsed = pin(df, _DOC, F.try_parse_json(F.col(value)))
    shaped = pin(parsed, _SHAPES, _all_shapes())
    cast = pin(shaped, _CAST, _cast())
    # In two parts, each a method small enough to be compiled.
    paths = list(_leaves())
    half = len(paths) // 2
    partly = pin(cast, _BAD, _bad_fields(paths[:half]))
    checked = pin(partly, "bad_fields", _bad_fields(paths[half:], F.col(_BAD)))
    id_shape = _shape("question_id")
    reason = (
        F.when(F.col(_DOC).isNull(), "bad_json")
        .when(~_is_object(), "not_object")
        .when(id_shape == "VOID", "null_id")
    )
    if missing_id == "reject":
        reason = reason.when(id_shape.isNull(), "missing_id")
    return checked.select(
        "*",
        reason.when(F.col("bad_fields") != "", "bad_type").alias("reason"),
        _projected().alias("post"),
    ).drop(_DOC, _SHAPES, _CAST, _BAD)


def valid_posts(checked: DataFrame) -> DataFrame:
    """The rows that keep the contract."""
    return checked.filter(F.col("reason").isNull()).drop("reason", "bad_fields")


def publishable(
    checked: DataFrame,
    source: str = "post-producer",
    encoding: str = "json",
    schema_version: str = "v1",
) -> DataFrame:
    """Messages for the main topic: contract JSON plus three attributes."""
    attributes = {
        "encoding": encoding,
        "schema_version": schema_version,
        "source": source,
    }
    pairs = [F.lit(part) for item in attributes.items() for part in item]
    return valid_posts(checked).select(
        "message_id",
        F.col("post.question_id").cast("string").alias("key"),
        post_json(F.col("post")).alias("value"),
        F.create_map(*pairs).alias("attributes"),
    )


def error_reason() -> Column:
    """Reason text of a faulty row, naming the fields of a wrong type."""
    return F.when(
        F.col("reason") == "bad_type",
        F.concat(F.lit("bad_type: "), "bad_fields"),
    ).otherwise(F.col("reason"))


def dead_letters(
    checked: DataFrame,
    source: str = "post-producer",
    failed_stage: str = "publish",
    timestamp: Column | None = None,
    value: str = "value",
) -> DataFrame:
    """The faulty rows with their original text and why they failed."""
    if timestamp is None:
        timestamp = utc_now()
    return checked.filter(F.col("reason").isNotNull()).select(
        "message_id",
        F.col(value).alias("raw"),
        error_reason().alias("error_reason"),
        F.lit(failed_stage).alias("failed_stage"),
        F.lit(source).alias("source"),
        timestamp.alias("timestamp"),
    )


def dead_messages(letters: DataFrame) -> DataFrame:
    """Dead letters as messages: the original text, and why it failed as attributes.

    The frame has the shape of a published one, so every sink takes it; the key
    is null.
    """
    names = ["error_reason", "failed_stage", "source", "timestamp"]
    pairs = [part for name in names for part in (F.lit(name), F.col(name))]
    return letters.select(
        "message_id",
        F.lit(None).cast("string").alias("key"),
        F.col("raw").alias("value"),
        F.create_map(*pairs).alias("attributes"),
    )


def routed(checked: DataFrame) -> DataFrame:
    """Add ``route``, "main" or "dead", to write both outputs in one pass."""
    return checked.withColumn(
        "route", F.when(F.col("reason").isNull(), "main").otherwise("dead")
    )
