"""What raw JSON records look like, over the whole dataset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.functions import json_shape_name, json_type_name
from postloom.operators.pinning import pin


def key_presence(df: DataFrame, value: str = "value") -> DataFrame:
    """Top-level keys: how many records have each, and which share that is.

    Records that are not JSON objects have no keys and do not count. Each
    record also yields one null key, so a single pass counts keys and records
    alike, per task first.
    """
    listed = pin(df.select(value), "_keys", F.json_object_keys(value)).filter(
        F.col("_keys").isNotNull()
    )
    nothing = F.array(F.lit(None).cast("string"))
    counted = (
        listed.select(
            F.explode(F.concat(nothing, F.array_distinct("_keys"))).alias("key")
        )
        .groupBy("key")
        .agg(
            F.count("*").alias("records"),
            # Not a filter on the key itself: that would be pushed below the
            # aggregation and the two uses would no longer share one shuffle.
            F.bool_or(F.col("key").isNull()).alias("_total"),
        )
    )
    total = counted.filter("_total").agg(F.max("records")).scalar()
    return counted.filter("NOT _total").select(
        "key", "records", (F.col("records") / total).alias("share")
    )


def field_types(
    df: DataFrame, fields: list[str], value: str = "value"
) -> DataFrame:
    """How often each of the named fields has each JSON type."""
    parsed = pin(df.select(value), "_doc", F.try_parse_json(value)).filter(
        F.col("_doc").isNotNull()
    )
    typed = F.array(
        *[
            F.struct(
                F.lit(field).alias("field"),
                json_type_name(
                    F.try_variant_get("_doc", f"$.{field}", "variant")
                ).alias("type"),
            )
            for field in fields
        ]
    )
    return (
        parsed.select(F.inline(typed))
        .groupBy("field", "type")
        .agg(F.count("*").alias("records"))
    )


# The type shown for a value below the last level.
_CUT = "..."


def _with_members(rows: DataFrame, level: int) -> DataFrame:
    """One row for each member of the values of a level, or one without a member.

    Adds the member's place among its fellows, path and value (``_place_1``, ``_path_1``,
    ``_value_1`` for members of level 0) and the type of the level's value, ``_type_0``: a
    key or none tells an object from an array, so only values without members are looked at.
    """
    value, path, member = F.col(f"_value_{level}"), F.col(f"_path_{level}"), level + 1
    found = rows.sparkSession.tvf.variant_explode_outer(value.outer()).toDF(
        f"_place_{member}", "_key", f"_value_{member}"
    )
    place, key = F.col(f"_place_{member}"), F.col("_key")
    step = F.when(key.isNotNull(), F.concat(F.lit("."), key)).otherwise("[]")
    return (
        rows.lateralJoin(found)
        .withColumn("_shape", F.when(place.isNull(), F.schema_of_variant(value)))
        .withColumns(
            {
                f"_type_{level}": F.when(place.isNull(), json_shape_name(F.col("_shape")))
                .when(key.isNotNull(), "dict")
                .otherwise("list"),
                f"_path_{member}": F.when(place.isNotNull(), F.concat(path, step)),
            }
        )
        .drop("_key", "_shape", f"_value_{level}")
    )


def _once(depth: int) -> Column:
    """The (path, type) of each level that a row is the first to show."""
    none = F.array().cast("array<struct<path:string,type:string>>")
    found, first = [], F.lit(True)
    for level in range(depth + 1, -1, -1):
        kind = F.lit(_CUT) if level > depth else F.col(f"_type_{level}")
        path = F.col(f"_path_{level}")
        own = F.array(F.struct(path.alias("path"), kind.alias("type")))
        found.append(F.when(first & path.isNotNull(), own).otherwise(none))
        first = first & (F.coalesce(F.col(f"_place_{level}"), F.lit(0)) == 0) if level else first
    return F.concat(*found)


def schema_paths(df: DataFrame, value: str = "value", depth: int = 4) -> DataFrame:
    """Every path down to ``depth`` with its types and how often it occurs.

    All list items count, not a sample of them. What lies deeper shows as one row
    of type ``...`` for each value cut off.
    """
    return shape_states(df, value=value, depth=depth)


def shape_states(
    df: DataFrame, *keys: str, value: str = "value", depth: int = 4
) -> DataFrame:
    """``schema_paths`` for each batch: keys, path, type and occurrences.

    The states of batches add up (``merged_shapes``), so a profile of all records needs
    none of them again.
    """
    parsed = pin(df.select(*keys, value), "_doc", F.try_parse_json(value)).filter(
        F.col("_doc").isNotNull()
    )
    rows = parsed.select(*keys, F.lit("$").alias("_path_0"), F.col("_doc").alias("_value_0"))
    # One generator a level; the rows of a value's members carry its path and type along.
    for level in range(depth + 1):
        rows = _with_members(rows, level)
    return (
        rows.select(*keys, F.inline(_once(depth)))
        .groupBy(*keys, "path", "type")
        .agg(F.count("*").alias("occurrences"))
    )


def merged_shapes(states: DataFrame) -> DataFrame:
    """path, type and occurrences over all states."""
    return states.groupBy("path", "type").agg(F.sum("occurrences").alias("occurrences"))


def schema_drift(before: DataFrame, after: DataFrame) -> DataFrame:
    """Paths whose types differ between two states, and how.

    ``change`` is "new", "gone", "widened" (more types than before), "narrowed" (fewer) or
    "changed" (some new, some gone). Types are listed in order, joined by ``|``.
    """

    def types(state: DataFrame, name: str) -> DataFrame:
        return state.groupBy("path").agg(F.sort_array(F.collect_set("type")).alias(name))

    both = types(before, "_before").join(types(after, "_after"), "path", "full")
    more = F.size(F.array_except("_after", "_before")) > 0
    fewer = F.size(F.array_except("_before", "_after")) > 0
    change = (
        F.when(F.col("_before").isNull(), "new")
        .when(F.col("_after").isNull(), "gone")
        .when(more & fewer, "changed")
        .when(more, "widened")
        .when(fewer, "narrowed")
    )
    return (
        both.withColumn("change", change)
        .where(F.col("change").isNotNull())
        .select(
            "path",
            "change",
            F.array_join("_before", "|").alias("types_before"),
            F.array_join("_after", "|").alias("types_after"),
        )
    )


def schema_merged(df: DataFrame, value: str = "value") -> DataFrame:
    """For each top-level type, the schema that all its records fit, and their number."""
    parsed = pin(df.select(value), "_doc", F.try_parse_json(value)).filter(
        F.col("_doc").isNotNull()
    )
    return parsed.groupBy(json_type_name(F.col("_doc")).alias("type")).agg(
        F.schema_of_variant_agg("_doc").alias("merged_schema"),
        F.count("*").alias("records"),
    )


def record_shapes(df: DataFrame, value: str = "value") -> DataFrame:
    """The distinct schemas of single records and how often each occurs."""
    parsed = pin(df.select(value), "_doc", F.try_parse_json(value)).filter(
        F.col("_doc").isNotNull()
    )
    return (
        parsed.groupBy(F.schema_of_variant("_doc").alias("shape"))
        .agg(F.count("*").alias("records"))
    )
