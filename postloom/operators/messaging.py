"""Topics, keys and subscriptions."""

from __future__ import annotations

import datetime
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Subscription:
    """A named view of a topic: from when on, and which attributes match.

    ``created`` is an ISO time, in UTC unless it names its own offset.
    """

    name: str
    created: str | None = None
    attributes: dict[str, str] = field(default_factory=dict)

    def start(self) -> Column | None:
        """The start as a timestamp, whatever the session's zone; None without one."""
        if self.created is None:
            return None
        at = datetime.datetime.fromisoformat(self.created)
        if at.tzinfo is None:
            at = at.replace(tzinfo=datetime.timezone.utc)
        zero = datetime.datetime(1970, 1, 1, tzinfo=datetime.timezone.utc)
        return F.timestamp_micros(F.lit((at - zero) // datetime.timedelta(microseconds=1)))

    def accepts(self) -> Column:
        """Predicate over ``publish_ts`` and ``attributes``."""
        tests = [
            F.coalesce(F.col("attributes")[key] == value, F.lit(False))
            for key, value in self.attributes.items()
        ]
        if self.created is not None:
            since = F.col("publish_ts") >= self.start()
            tests.append(F.coalesce(since, F.lit(False)))
        return reduce(Column.__and__, tests, F.lit(True))


def subscribe(messages: DataFrame, subscription: Subscription) -> DataFrame:
    """What one subscription receives; works on batches and on streams."""
    return messages.filter(subscription.accepts())


def fan_out(messages: DataFrame, subscriptions: list[Subscription]) -> DataFrame:
    """Every subscription's own copy, marked with its name.

    One pass over the topic: each row is repeated once per subscription that
    accepts it, so nothing is joined or shuffled.
    """
    names = F.array_compact(
        F.array(*[F.when(s.accepts(), F.lit(s.name)) for s in subscriptions])
    )
    return messages.select(F.explode(names).alias("subscription"), "*")


def split_keyed(
    lines: DataFrame, line: str = "line", separator: str = ":"
) -> DataFrame:
    """Split ``key:value`` lines at the first separator.

    A line without one has a null key and is its own value.
    """
    at = F.instr(F.col(line), separator)
    return lines.withColumns(
        {
            "key": F.when(at > 0, F.substring(F.col(line), F.lit(1), at - 1)),
            "value": F.when(
                at > 0,
                F.substring(F.col(line), at + len(separator), F.length(line)),
            ).otherwise(F.col(line)),
        }
    )


def topic_partition(key: Column, partitions: int = 3) -> Column:
    """Topic partition of a key: equal keys always share one."""
    digest = F.substring(F.md5(F.coalesce(key, F.lit(""))), 1, 8)
    return (F.conv(digest, 16, 10).cast("bigint") % partitions).cast("int")


def positions_within(
    df: DataFrame,
    order: str,
    positions: dict[str, list[str]],
    span: int = 1_000_000,
) -> DataFrame:
    """Exact 0-based positions of each row within its keys, in ``order``.

    ``positions`` maps a new column to the keys it counts within. A window
    over the keys alone would sort a hot key in one task. Rows are instead
    numbered within blocks of ``span`` consecutive order values, and each
    block starts where the earlier blocks of its keys end. Only block counts,
    added up before the shuffle, are ever brought together per key. ``order``
    is a whole number that is unique within a key, such as an arrival number.

    Name the position with the fewest keys first: a later one whose keys
    include them is then numbered without another shuffle, and with
    ``spark.sql.requireAllClusterKeysForCoPartition`` off, as ``build_session`` sets it,
    the joins keep that partitioning too: the rows are shuffled once.
    """
    # Keys without nulls make plain equal joins, which fit the windows' partitioning.
    every = list(dict.fromkeys(key for keys in positions.values() for key in keys))
    plain = {}
    for key in every:
        kind = df.schema[key].dataType.simpleString()
        plain[f"_has_{key}"] = F.col(key).isNotNull()
        plain[f"_key_{key}"] = F.coalesce(F.col(key), F.lit("0").cast(kind))
    blocked = df.withColumns(
        {**plain, "_block": F.col(order) - F.pmod(order, F.lit(span))}
    )
    positions = {
        name: [f"_{part}_{key}" for key in keys for part in ("has", "key")]
        for name, keys in positions.items()
    }
    numbered = blocked
    for name, keys in positions.items():
        within = Window.partitionBy(*keys, "_block").orderBy(order)
        numbered = numbered.withColumn(name, F.row_number().over(within) - 1)
    for name, keys in positions.items():
        earlier = (
            Window.partitionBy(*keys)
            .orderBy("_block")
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        starts = (
            blocked.groupBy(*keys, "_block")
            .agg(F.count("*").alias("_rows"))
            .select(
                *[F.col(key).alias(f"_of_{key}") for key in keys],
                F.col("_block").alias("_at"),
                F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"),
            )
        )
        same = [F.col(key) == F.col(f"_of_{key}") for key in keys]
        matching = reduce(Column.__and__, same, F.col("_block") == F.col("_at"))
        numbered = (
            numbered.join(starts, matching, "inner")
            .withColumn(name, F.col(name) + F.col("_start"))
            .drop("_at", "_start", *[f"_of_{key}" for key in keys])
        )
    return numbered.drop("_block", *plain)


def keyed_order(
    messages: DataFrame, partitions: int = 3, span: int = 1_000_000
) -> DataFrame:
    """Topic partition, offset within it, and position within the key."""
    placed = messages.withColumn("partition", topic_partition(F.col("key"), partitions))
    wanted = {"offset": ["partition"], "key_position": ["partition", "key"]}
    return positions_within(placed, "seq", wanted, span)
