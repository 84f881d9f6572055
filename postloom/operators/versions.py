"""Reading messages that were written under several versions of a contract.

A message names its version in an attribute. Its record is read by the fields of that
version and resolved to the reader's: numbers are promoted, fields that the
version lacks get the reader's default, and fields that the reader lacks are left behind.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postloom.operators.pinning import pin

# The types that a number may be read as, besides its own.
PROMOTIONS: dict[type, tuple[type, ...]] = {
    T.IntegerType: (T.LongType, T.FloatType, T.DoubleType),
    T.LongType: (T.FloatType, T.DoubleType),
    T.FloatType: (T.DoubleType,),
}


@dataclass(frozen=True)
class Version:
    """A version of the contract: its name, fields, and defaults for older records.

    A field that is not nullable has to be there and not null.
    """

    name: str
    fields: T.StructType
    defaults: dict[str, object] = field(default_factory=dict)


def _fits(written: T.DataType, read: T.DataType) -> bool:
    if isinstance(written, T.ArrayType) and isinstance(read, T.ArrayType):
        return _fits(written.elementType, read.elementType)
    return written == read or type(read) in PROMOTIONS.get(type(written), ())


def conflicts(writer: Version, reader: Version) -> list[str]:
    """Why the reader cannot read records of the writer; empty when it can."""
    written = {f.name: f for f in writer.fields}
    found = []
    for own in reader.fields:
        there = written.get(own.name)
        if there is None:
            if own.name not in reader.defaults and not own.nullable:
                found.append(f"{own.name}: not in {writer.name}, and without a default")
        elif not _fits(there.dataType, own.dataType):
            kinds = f"{there.dataType.simpleString()} to {own.dataType.simpleString()}"
            found.append(f"{own.name}: {kinds}")
    return found


def _default(own: T.StructField, reader: Version) -> Column:
    value = reader.defaults.get(own.name)
    if isinstance(value, list):
        return F.array(*[F.lit(item) for item in value]).cast(own.dataType)
    return F.lit(value).cast(own.dataType)


def _resolved(parsed: Column, writer: Version, reader: Version) -> Column:
    """A record of one version as the reader's."""
    written = set(writer.fields.fieldNames())
    fields = [
        (parsed[own.name].cast(own.dataType) if own.name in written else _default(own, reader))
        .alias(own.name)
        for own in reader.fields
    ]
    return F.struct(*fields)


def resolve(
    messages: DataFrame,
    versions: list[Version],
    reader: Version,
    value: str = "value",
    attribute: str = "schema_version",
) -> DataFrame:
    """Add ``post``, the reader's record, and ``reason``, null where it is sound.

    Reasons: "unknown_version" (none named, or not among ``versions``), "bad_json",
    "bad_type" (a value that the named version does not allow) and "missing: <field>".
    Each record is parsed once, by its own version. Versions that the reader cannot
    read are refused at once.
    """
    problems = [p for v in versions for p in conflicts(v, reader)]
    if problems:
        raise ValueError("versions do not fit the reader: " + "; ".join(problems))
    named = F.col("attributes")[attribute]
    rows, cases = messages, []
    for number, writer in enumerate(versions):
        # Nullable for the parser: a missing value is told below.
        loose = T.StructType([T.StructField(f.name, f.dataType) for f in writer.fields])
        whole = loose.add("_corrupt", T.StringType())
        parsed = F.from_json(value, whole, {"columnNameOfCorruptRecord": "_corrupt"})
        rows = pin(rows, f"_v{number}", F.when(named == writer.name, parsed))
        cases.append((F.col(f"_v{number}"), writer))
    known = F.coalesce(named.isin([v.name for v in versions]), F.lit(False))
    post, corrupt = F.lit(None), F.lit(None).cast("string")
    for parsed, writer in reversed(cases):
        own = named == writer.name
        post = F.when(own, _resolved(parsed, writer, reader)).otherwise(post)
        corrupt = F.when(own, parsed["_corrupt"]).otherwise(corrupt)
    missing = F.concat_ws(
        ", ",
        *[
            F.when(F.col("post")[own.name].isNull(), own.name)
            for own in reader.fields
            if not own.nullable
        ],
    )
    rows = pin(rows.withColumn("_broken", corrupt), "post", post)
    reason = (
        F.when(~known, "unknown_version")
        .when(F.col("_broken").isNotNull() & F.try_parse_json(value).isNull(), "bad_json")
        .when(F.col("_broken").isNotNull(), "bad_type")
        .when(missing != "", F.concat(F.lit("missing: "), missing))
    )
    rows = rows.withColumn("reason", reason)
    kept = F.when(F.col("reason").isNull(), F.col("post"))
    return rows.withColumn("post", kept).drop("_broken", *[f"_v{n}" for n in range(len(cases))])
