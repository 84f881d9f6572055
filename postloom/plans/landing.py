"""From delivered envelopes to stored posts and dead letters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.functions import epoch_seconds, utc_now
from postloom.operators.contract import check_contract, error_reason
from postloom.operators.envelope import open_envelopes
from postloom.operators.pinning import pin
from postloom.schema import OWNER, POST
from postloom.sinks.files import Batch, append_table, write_hour_partitions, write_json_archive


def receive(lines: DataFrame, missing_id: str = "zero") -> DataFrame:
    """Open envelopes and check their payloads, one row per line.

    Adds ``message_id``, ``post``, and for rows that cannot be stored
    ``failed_stage`` and ``error_reason``. A post without a creation time, or
    with one outside the years 1 to 9999, has no hour to be stored under and
    fails at stage "partition". ``landed_at`` and ``position`` tell the order of
    arrival: the time of the batch and the row's place in it.
    """
    opened = open_envelopes(lines).withColumn("text", F.col("payload").cast("string"))
    checked = check_contract(opened, "text", missing_id)
    stage = (
        F.when(F.col("status") != "ok", "envelope")
        .when(F.col("payload").isNull(), "decode")
        .when(F.col("reason").isNotNull(), "contract")
        .when(epoch_seconds(F.col("post.creation_date")).isNull(), "partition")
    )
    cause = (
        F.when(F.col("status") != "ok", F.col("status"))
        .when(F.col("payload").isNull(), "bad_base64")
        .when(F.col("reason").isNotNull(), error_reason())
        .when(F.col("post.creation_date").isNull(), "no_creation_date")
        .when(epoch_seconds(F.col("post.creation_date")).isNull(), "bad_creation_date")
    )
    return checked.select(
        F.col("value").alias("raw"),
        "message_id",
        "post",
        stage.alias("failed_stage"),
        cause.alias("error_reason"),
        F.current_timestamp().alias("landed_at"),
        F.monotonically_increasing_id().alias("position"),
    )


def flattened(posts: DataFrame) -> DataFrame:
    """Rows with ``post`` as plain columns, the form to cache them in.

    A cache packs plain columns by themselves and keeps a struct as the bytes of its row.
    """
    fields = [f for f in POST.fieldNames() if f != "owner"]
    others = [c for c in posts.columns if c != "post"]
    # Pinned, so that what makes the post is compiled apart from what takes it apart: both
    # in one method are too much for Java's compiler.
    pinned = pin(posts, "_post", F.col("post"))
    return pinned.select(
        *others,
        *[F.col(f"_post.{f}").alias(f"_post_{f}") for f in fields],
        F.col("_post.owner").isNotNull().alias("_owned"),
        *[F.col(f"_post.owner.{f}").alias(f"_owner_{f}") for f in OWNER.fieldNames()],
    )


def unflattened(flat: DataFrame) -> DataFrame:
    """The rows that ``flattened`` took apart."""
    owner = F.when(
        F.col("_owned"),
        F.struct(*[F.col(f"_owner_{f}").alias(f) for f in OWNER.fieldNames()]),
    )
    fields = [
        (owner if f == "owner" else F.col(f"_post_{f}")).alias(f) for f in POST.fieldNames()
    ]
    others = [c for c in flat.columns if not c.startswith(("_post_", "_owner_", "_owned"))]
    return flat.select(*others, F.struct(*fields).alias("post"))


def without_spent_text(received: DataFrame) -> DataFrame:
    """Received rows with ``raw`` for those to be refused only, whom alone it is stored for."""
    return received.withColumn("raw", F.when(F.col("failed_stage").isNotNull(), F.col("raw")))


def stored(received: DataFrame) -> DataFrame:
    """The rows every store takes."""
    return received.filter(F.col("failed_stage").isNull()).select(
        "message_id", "post", "landed_at", "position"
    )


def refused(
    received: DataFrame, source: str = "post-consumer", timestamp: Column | None = None
) -> DataFrame:
    """The rows that go to the dead letters."""
    if timestamp is None:
        timestamp = utc_now()
    return received.filter(F.col("failed_stage").isNotNull()).select(
        "message_id",
        "raw",
        "error_reason",
        "failed_stage",
        F.lit(source).alias("source"),
        timestamp.alias("timestamp"),
    )


def land(received: DataFrame, root: str, batch: Batch | None = None) -> None:
    """Write one received batch to the JSON archive, the hour-partitioned
    files, the table, and the dead letters.

    ``received`` is read four times; a caller whose batch is costly to work
    out caches it first (see streaming/ingest.py).
    """
    posts = stored(received)
    flat = posts.select("message_id", "post.*", "landed_at", "position")
    write_json_archive(posts, f"{root}/json", batch)
    write_hour_partitions(flat, f"{root}/parquet", batch)
    append_table(flat, f"{root}/table", batch)
    append_table(refused(received), f"{root}/dead_letters", batch)
