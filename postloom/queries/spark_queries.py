"""Registered queries: name -> function of (session, data folder)."""

from __future__ import annotations

import datetime
import functools
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postloom import functions as pf
from postloom.operators import (
    contract,
    distinct,
    messaging,
    newest,
    profiling,
    quality,
    ranking,
)
from postloom.operators import versions as contract_versions_of
from postloom.operators.envelope import open_envelopes
from postloom.plans import incremental, landing, medallion, serving
from postloom.plans.checkpoint import run_checkpoint
from postloom.schema import POST, STORED
from postloom.session import scratch_path
from postloom.sinks import checked, commits, files, objects
from postloom.sinks.versions import file_bytes
from postloom.sources import event_posts, tables, topics
from postloom.streaming import ingest, positions, subscriptions

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register a query under its function name."""
    REGISTRY[build.__name__] = build
    return build


FIXED_TIME = "2024-02-01T00:00:00"
RUN_ID = "20240201-000000-check"
RANGE = (datetime.date(2024, 1, 10), datetime.date(2024, 1, 16))
LOOKED_UP = [7, 42, 500, 901]
NEW_FIELD_BATCH = 19738  # 2024-01-16 as a day number
TOPIC_FILES = 16  # of a topic in one micro-batch
RANGE_BYTES = 4 << 20  # of input files for one file of a topic by ranges

SUBSCRIPTIONS = [
    messaging.Subscription("all"),
    messaging.Subscription("all-backup"),
    messaging.Subscription("later", created="2024-01-15 00:00:00"),
    messaging.Subscription("clicks", attributes={"key": "click"}),
]


def _silver(spark: SparkSession, root: str) -> DataFrame:
    return medallion.silver(event_posts.posts(spark, root))


def _gold(spark: SparkSession, root: str) -> DataFrame:
    return medallion.gold(_silver(spark, root))


def _lines(spark: SparkSession, root: str) -> DataFrame:
    """Raw messages without the blank ones."""
    rows = event_posts.messages(spark, root)
    return rows.filter(pf.not_blank_line(F.col("value")))


def _checked(spark: SparkSession, root: str, missing_id: str = "zero") -> DataFrame:
    return contract.check_contract(_lines(spark, root), missing_id=missing_id)


def _tags(tags: Column | str = "tags") -> Column:
    return F.array_join(tags, "|").alias("tags")


def _flat_post(prefix: str = "") -> list[Column]:
    """Contract fields as plain columns."""
    scalars = [f.name for f in POST.fields if f.name not in ("tags", "owner")]
    owner = ["account_id", "user_id", "reputation", "user_type", "display_name"]
    return [
        *[F.col(f"{prefix}{name}").alias(name) for name in scalars],
        _tags(F.col(f"{prefix}tags")),
        *[F.col(f"{prefix}owner.{name}").alias(f"owner_{name}") for name in owner],
        F.col(f"{prefix}owner").isNull().alias("owner_missing"),
    ]


# --- bronze, silver, gold -------------------------------------------------


@query
def bronze_posts(spark: SparkSession, root: str) -> DataFrame:
    rows = medallion.bronze(event_posts.posts(spark, root))
    return rows.select("seq", "batch_id", "message_id", *_flat_post())


@query
def silver_dedup(spark: SparkSession, root: str) -> DataFrame:
    rows = newest.newest_capture(event_posts.captures(spark, root))
    return rows.select("question_id", "message_id", "creation_date", "score")


@query
def silver_posts(spark: SparkSession, root: str) -> DataFrame:
    rows = _silver(spark, root)
    return rows.withColumn("created_ts", F.col("created_ts").cast("timestamp_ntz"))


@query
def title_clean(spark: SparkSession, root: str) -> DataFrame:
    return event_posts.posts(spark, root).select(
        "message_id",
        pf.clean_title(F.col("title")).alias("title_clean"),
        pf.has_text(F.col("title")).alias("has_text"),
    )


@query
def sentiment_class(spark: SparkSession, root: str) -> DataFrame:
    return event_posts.captures(spark, root).select(
        "message_id",
        pf.sentiment(F.col("score"), F.col("answer_count")).alias("sentiment"),
    )


@query
def epoch_convert(spark: SparkSession, root: str) -> DataFrame:
    created = pf.epoch_ts(F.col("creation_date"))
    return event_posts.captures(spark, root).select(
        "message_id",
        created.cast("timestamp_ntz").alias("created_ts"),
        F.to_date(created).alias("created_date"),
    )


@query
def gold_posts(spark: SparkSession, root: str) -> DataFrame:
    return _gold(spark, root)


@query
def gold_daily(spark: SparkSession, root: str) -> DataFrame:
    return medallion.daily(_silver(spark, root))


@query
def gold_rolling(spark: SparkSession, root: str) -> DataFrame:
    return medallion.daily(_silver(spark, root)).select(
        "report_date",
        "sentiment",
        medallion.rolling_rows().alias("posts_rolling_7d"),
    )


@query
def gold_rolling_calendar(spark: SparkSession, root: str) -> DataFrame:
    return medallion.daily(_silver(spark, root)).select(
        "report_date",
        "sentiment",
        medallion.rolling_rows().alias("rolling_rows"),
        medallion.rolling_calendar().alias("rolling_calendar"),
    )


@query
def gold_lag(spark: SparkSession, root: str) -> DataFrame:
    return medallion.daily(_silver(spark, root)).select(
        "report_date",
        "sentiment",
        "post_count",
        medallion.previous_count().alias("prev_day_posts"),
    )


@query
def gold_dod(spark: SparkSession, root: str) -> DataFrame:
    return _gold(spark, root).select(
        "report_date", "sentiment", "day_over_day_change_pct"
    )


@query
def silver_day_partitions(spark: SparkSession, root: str) -> DataFrame:
    path = scratch_path(spark, "silver")
    files.replace_table(
        medallion.silver_table(_silver(spark, root)), path, "created_date", "sentiment"
    )
    return (
        files.read_table(spark, path)
        .groupBy("created_date", "sentiment")
        .agg(
            F.count("*").alias("posts"),
            F.sum("score_filled").alias("total_score"),
            F.sum(F.length("title_clean")).alias("title_chars"),
        )
    )


@query
def gold_readback_pruned(spark: SparkSession, root: str) -> DataFrame:
    path = scratch_path(spark, "gold")
    files.replace_table(_gold(spark, root), path, "report_date", "sentiment")
    gold = serving.date_range(files.read_table(spark, path), *RANGE)
    return serving.with_sentiments(gold, ["POSITIVE", "NEGATIVE"]).select(
        "report_date", "sentiment", "post_count", "posts_rolling_7d"
    )


@query
def trend_long(spark: SparkSession, root: str) -> DataFrame:
    return serving.trend_long(_gold(spark, root))


@query
def trend_wide(spark: SparkSession, root: str) -> DataFrame:
    return serving.trend_wide(_gold(spark, root))


@query
def trend_date_range(spark: SparkSession, root: str) -> DataFrame:
    return serving.trend_long(serving.date_range(_gold(spark, root), *RANGE))


@query
def trend_sentiment_filter(spark: SparkSession, root: str) -> DataFrame:
    chosen = ["HIGH_ENGAGEMENT", "NEGATIVE"]
    return serving.trend_long(serving.with_sentiments(_gold(spark, root), chosen))


# --- choosing posts -------------------------------------------------------


def _top(spark: SparkSession, root: str, sort: str, order: str) -> DataFrame:
    rows = newest.newest_capture(event_posts.captures(spark, root))
    top = ranking.top_posts(rows, sort, order, tagged="click", pagesize=100)
    return top.select(
        "question_id", "score", "creation_date", "last_activity_date", _tags(), "link"
    )


@query
def top_posts_votes(spark: SparkSession, root: str) -> DataFrame:
    return _top(spark, root, "votes", "desc")


@query
def top_posts_activity(spark: SparkSession, root: str) -> DataFrame:
    return _top(spark, root, "activity", "desc")


@query
def top_posts_creation(spark: SparkSession, root: str) -> DataFrame:
    return _top(spark, root, "creation", "asc")


@query
def filter_votes_tags(spark: SparkSession, root: str) -> DataFrame:
    rows = ranking.filter_posts(event_posts.posts(spark, root), 30, "purchase")
    return rows.select("message_id", "question_id", "title", "score", _tags())


# --- contract -------------------------------------------------------------


@query
def contract_project(spark: SparkSession, root: str) -> DataFrame:
    rows = contract.valid_posts(_checked(spark, root))
    return rows.select("message_id", *_flat_post("post."))


@query
def contract_valid(spark: SparkSession, root: str) -> DataFrame:
    return _checked(spark, root).select(
        "message_id", F.col("reason").isNull().alias("valid")
    )


@query
def contract_reasons(spark: SparkSession, root: str) -> DataFrame:
    return (
        _checked(spark, root, missing_id="reject")
        .withColumn("error_reason", contract.error_reason())
        .groupBy(F.coalesce("error_reason", F.lit("ok")).alias("error_reason"))
        .agg(F.count("*").alias("messages"))
    )


@query
def publish_main(spark: SparkSession, root: str) -> DataFrame:
    rows = contract.publishable(_checked(spark, root))
    names = ["encoding", "schema_version", "source"]
    return rows.select(
        "message_id",
        "key",
        "value",
        *[F.col("attributes")[name].alias(name) for name in names],
    )


@query
def dead_letters(spark: SparkSession, root: str) -> DataFrame:
    return contract.dead_letters(_checked(spark, root), timestamp=F.lit(FIXED_TIME))


@query
def publish_dead(spark: SparkSession, root: str) -> DataFrame:
    letters = contract.dead_letters(_checked(spark, root), timestamp=F.lit(FIXED_TIME))
    rows = contract.dead_messages(letters)
    names = ["error_reason", "failed_stage", "source", "timestamp"]
    return rows.select(
        "message_id",
        "key",
        "value",
        *[F.col("attributes")[name].alias(name) for name in names],
    )


@query
def split_counts(spark: SparkSession, root: str) -> DataFrame:
    rows = contract.routed(_checked(spark, root))
    return rows.groupBy("route").agg(F.count("*").alias("messages"))


# --- envelopes ------------------------------------------------------------


@query
def envelope_status(spark: SparkSession, root: str) -> DataFrame:
    return open_envelopes(event_posts.envelopes(spark, root)).select("seq", "status")


@query
def envelope_decode(spark: SparkSession, root: str) -> DataFrame:
    rows = open_envelopes(event_posts.envelopes(spark, root))
    return rows.filter(F.col("status") == "ok").select(
        "message_id", F.col("payload").cast("string").alias("payload_text")
    )


@query
def payload_preview(spark: SparkSession, root: str) -> DataFrame:
    rows = open_envelopes(event_posts.envelopes(spark, root))
    return rows.filter(F.col("payload").isNotNull()).select(
        "message_id",
        pf.payload_length(F.col("payload")).alias("bytes"),
        pf.payload_preview(F.col("payload")).alias("first_bytes"),
    )


# --- stores ---------------------------------------------------------------


@query
def json_archive(spark: SparkSession, root: str) -> DataFrame:
    path = scratch_path(spark, "json")
    files.write_json_archive(contract.valid_posts(_checked(spark, root)), path)
    return files.read_json_archive(spark, path)


@query
def hour_partition_path(spark: SparkSession, root: str) -> DataFrame:
    path = pf.object_path(F.col("creation_date"), F.col("question_id"))
    return event_posts.captures(spark, root).select("message_id", path.alias("path"))


def _hour_files(spark: SparkSession, root: str) -> DataFrame:
    """Captures read back from their hours, and those without one, which none can hold."""
    path = scratch_path(spark, "hours")
    rows = event_posts.captures(spark, root).select(
        "message_id", "question_id", "score", "creation_date"
    )
    timed = pf.epoch_seconds(F.col("creation_date")).isNotNull()
    files.write_hour_partitions(rows.filter(timed), path)
    kept = files.read_hour_partitions(spark, path, rows.schema)
    return kept.unionByName(rows.filter(~timed), allowMissingColumns=True)


@query
def partitioned_readback(spark: SparkSession, root: str) -> DataFrame:
    return _hour_files(spark, root)


@query
def hour_partition_counts(spark: SparkSession, root: str) -> DataFrame:
    return (
        _hour_files(spark, root)
        .groupBy("year", "month", "day", "hour")
        .agg(F.count("*").alias("posts"), F.max("score").alias("top_score"))
    )


@query
def object_latest(spark: SparkSession, root: str) -> DataFrame:
    hour = pf.hour_path(F.col("creation_date"))
    rows = event_posts.captures(spark, root)
    untimed = pf.epoch_seconds(F.col("creation_date")).isNull()
    # A capture without a time has no object, so that none replaces it.
    rows = newest.latest_object(rows.filter(~untimed), hour).unionByName(rows.filter(untimed))
    return rows.select(hour.alias("hour_path"), "question_id", "message_id", "score")


@query
def object_lookup(spark: SparkSession, root: str) -> DataFrame:
    path = scratch_path(spark, "lookup")
    rows = event_posts.captures(spark, root).select(
        "message_id", "question_id", "score", "creation_date"
    )
    files.write_hour_partitions(rows.filter("creation_date IS NOT NULL"), path)
    found = files.lookup_questions(spark, path, rows.schema, LOOKED_UP)
    return found.select("message_id", "question_id", "score", pf.hour_path(F.col("creation_date")).alias("hour_path"))


@query
def append_field_addition(spark: SparkSession, root: str) -> DataFrame:
    path = scratch_path(spark, "append")
    rows = event_posts.captures(spark, root)
    early = F.col("batch_id") < NEW_FIELD_BATCH
    files.append_table(rows.filter(early).select("message_id", "question_id"), path)
    files.append_table(
        rows.filter(~early).select("message_id", "question_id", "content_license"), path
    )
    return files.read_appended(spark, path)


# --- file topics ----------------------------------------------------------


@query
def topic_scan(spark: SparkSession, root: str) -> DataFrame:
    path = scratch_path(spark, "topic")
    files.write_topic(event_posts.messages(spark, root), path)
    rows = topics.topic_posts(topics.read_topic(spark, path))
    return rows.withColumn("tags", _tags())


@query
def topic_write_roundtrip(spark: SparkSession, root: str) -> DataFrame:
    path = scratch_path(spark, "topic")
    fields = POST.fieldNames()
    files.write_topic(files.as_lines(event_posts.posts(spark, root).select(*fields)), path)
    rows = topics.topic_posts(topics.read_topic(spark, path), fields)
    return rows.select(*_flat_post(), "error_reason")


@query
def topic_limit(spark: SparkSession, root: str) -> DataFrame:
    rows = ranking.first_messages(_lines(spark, root), 10)
    return rows.select("seq", "message_id", "value")


@query
def topic_log_lines(spark: SparkSession, root: str) -> DataFrame:
    return event_posts.posts(spark, root).select(
        "message_id",
        F.concat(
            F.lit("score="),
            F.coalesce(F.col("score").cast("string"), F.lit("?")),
            F.lit(" title="),
            pf.title_preview(F.col("title")),
            F.lit(" link="),
            F.coalesce("link", F.lit("")),
        ).alias("log_line"),
    )


# --- versions of the contract ---------------------------------------------


def _versions() -> list[contract_versions_of.Version]:
    """Three versions: a wider id, then tags, then a license and no link."""

    def fields(text: str) -> T.StructType:
        names = [part.split(" ") for part in text.split(", ")]
        return T.StructType(
            [T.StructField(name, kinds[kind], name != "question_id") for name, kind in names]
        )

    kinds = {
        "int": T.IntegerType(),
        "bigint": T.LongType(),
        "double": T.DoubleType(),
        "string": T.StringType(),
        "list": T.ArrayType(T.StringType()),
    }
    defaults = {"tags": ["untagged"], "content_license": "CC BY-SA 4.0"}
    of = contract_versions_of.Version
    return [
        of("v1", fields("question_id int, title string, score int, link string")),
        of("v2", fields("question_id bigint, title string, score int, link string, tags list")),
        of(
            "v3",
            fields("question_id bigint, title string, score double, tags list, content_license string"),
            defaults,
        ),
    ]


@query
def contract_versions(spark: SparkSession, root: str) -> DataFrame:
    rows = event_posts.captures(spark, root).withColumn("title", F.col("own_title"))
    every = _versions()
    written = F.lit("{}")
    for number, version in enumerate(every):
        record = F.to_json(F.struct(*version.fields.fieldNames()))
        written = F.when(F.col("seq") % 4 == number, record).otherwise(written)
    faulty = (
        F.when(F.col("k") == 1, "not json")
        .when(F.col("k") == 2, '{"question_id":"x"}')
        .when(F.col("k") == 3, '{"title":"no id"}')
        .otherwise(written)
    )
    named = F.concat(F.lit("v"), F.col("seq") % 4 + 1)
    messages = rows.select(
        "message_id",
        faulty.alias("value"),
        F.create_map(F.lit("schema_version"), named).alias("attributes"),
    )
    found = contract_versions_of.resolve(messages, every, every[-1])
    return found.select(
        "message_id",
        "reason",
        *[F.col(f"post.{n}").alias(n) for n in ("question_id", "title", "score")],
        _tags(F.col("post.tags")),
        "post.content_license",
    )


# --- keys and subscriptions -----------------------------------------------


@query
def keyed_topic_scan(spark: SparkSession, root: str) -> DataFrame:
    path = scratch_path(spark, "keyed")
    files.write_topic(event_posts.keyed_lines(spark, root), path, "line")
    rows = messaging.split_keyed(topics.read_topic(spark, path), "value")
    return rows.select("key", "value")


@query
def keyed_order(spark: SparkSession, root: str) -> DataFrame:
    rows = messaging.split_keyed(event_posts.keyed_lines(spark, root))
    return messaging.keyed_order(rows.select("seq", "key")).select(
        "seq", "key", "partition", "offset", "key_position"
    )


@query
def stream_keyed_order(spark: SparkSession, root: str) -> DataFrame:
    path = scratch_path(spark, "order")
    rows = messaging.split_keyed(event_posts.keyed_lines(spark, root)).select("seq", "key")
    # A stream takes files by their age, so each batch is written after the one before it.
    part = F.floor(F.col("seq") * 7 / (rows.agg(F.max("seq")).scalar() + 1))
    for number in range(7):
        rows.where(part == number).coalesce(1).write.mode("append").parquet(f"{path}/topic")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1)
    stream = stream.parquet(f"{path}/topic")
    # Totals every three batches: some batches start from totals, some from counts as well.
    positions.start_keyed_order(
        stream, f"{path}/out", f"{path}/checkpoint", every=3
    ).awaitTermination()
    return spark.read.parquet(f"{path}/out/rows").select(
        "seq", "key", "partition", "offset", "key_position"
    )


@query
def subscription_filter(spark: SparkSession, root: str) -> DataFrame:
    only = messaging.Subscription("purchases", attributes={"key": "purchase"})
    rows = messaging.subscribe(event_posts.messages(spark, root), only)
    return rows.select("message_id", "value")


@query
def subscription_start(spark: SparkSession, root: str) -> DataFrame:
    later = messaging.Subscription("later", created="2024-01-15 00:00:00")
    rows = messaging.subscribe(event_posts.messages(spark, root), later)
    return rows.select("message_id", "seq")


@query
def subscription_fanout(spark: SparkSession, root: str) -> DataFrame:
    rows = messaging.fan_out(event_posts.messages(spark, root), SUBSCRIPTIONS)
    return rows.select("subscription", "message_id", F.length("value").alias("chars"))


# --- data quality ---------------------------------------------------------


@query
def dq_latest_batch(spark: SparkSession, root: str) -> DataFrame:
    rows = tables.latest_batch(event_posts.captures(spark, root))
    return rows.select("batch_id", "message_id", "question_id", "score")


@query
def dq_unique(spark: SparkSession, root: str) -> DataFrame:
    return quality.duplicated(event_posts.captures(spark, root), "question_id")


@query
def dq_not_null(spark: SparkSession, root: str) -> DataFrame:
    checks = [quality.not_null("question_id"), quality.not_null("sentiment")]
    return quality.run_suite(_silver(spark, root), checks, "posts_silver", RUN_ID)


@query
def dq_bronze(spark: SparkSession, root: str) -> DataFrame:
    rows = event_posts.posts(spark, root)
    return quality.run_suite(rows, medallion.bronze_suite(), "posts_bronze", RUN_ID)


@query
def dq_silver(spark: SparkSession, root: str) -> DataFrame:
    path = scratch_path(spark, "checks")
    rows = medallion.silver_table(_silver(spark, root))
    files.replace_table(rows, f"{path}/silver", "created_date", "sentiment")
    # A suite runs on the stored table: its passes then read columns of that,
    # and do not work silver out again.
    stored = files.read_table(spark, f"{path}/silver", rows.schema)
    found = quality.run_suite(stored, medallion.silver_suite(), "posts_silver", RUN_ID)
    files.store_results(found, f"{path}/results")
    return spark.read.schema(found.schema).parquet(f"{path}/results")


@query
def dq_checkpoint(spark: SparkSession, root: str) -> DataFrame:
    path = scratch_path(spark, "checkpoint")
    tables.expose_view(event_posts.posts(spark, root), "posts_bronze")
    suite = medallion.bronze_suite()
    # The second attempt at a run replaces the first.
    for _ in range(2):
        found = run_checkpoint(spark, "posts_bronze", suite, RUN_ID, path)
    return found


@query
def stream_checks(spark: SparkSession, root: str) -> DataFrame:
    path = scratch_path(spark, "observed")
    rows = event_posts.posts(spark, root).select("seq", *POST.fieldNames())
    # Uniqueness does not add up over batches; dq_bronze has it.
    suite = [check for check in medallion.bronze_suite() if check.name != "unique"]
    stream = _batches_by_time(spark, rows, f"{path}/topic", 4)

    def write(batch: DataFrame, own: files.Batch) -> None:
        checked.write_checked(
            batch,
            suite,
            f"{path}/states",
            own,
            lambda out: files.append_table(out, f"{path}/table", own),
        )

    ingest.run_batches(stream, write, f"{path}/checkpoint").awaitTermination()
    return checked.merged_results(spark, suite, f"{path}/states", "posts_bronze", RUN_ID)


# --- schema profiles ------------------------------------------------------


@query
def key_presence(spark: SparkSession, root: str) -> DataFrame:
    return profiling.key_presence(_lines(spark, root))


@query
def field_types(spark: SparkSession, root: str) -> DataFrame:
    fields = ["question_id", "title", "link", "score", "tags", "creation_date", "owner"]
    return profiling.field_types(_lines(spark, root), fields)


@query
def schema_paths(spark: SparkSession, root: str) -> DataFrame:
    return profiling.schema_paths(_lines(spark, root), depth=4)


@query
def record_shapes(spark: SparkSession, root: str) -> DataFrame:
    return profiling.record_shapes(_lines(spark, root))


@query
def schema_merged(spark: SparkSession, root: str) -> DataFrame:
    return profiling.schema_merged(_lines(spark, root))


@query
def schema_drift(spark: SparkSession, root: str) -> DataFrame:
    path = scratch_path(spark, "drift")
    # Four batches; the last one has the messages whose fields are all faultless or null.
    lines = _lines(spark, root).withColumn("batch", F.least(F.floor(F.col("k") / 6), F.lit(3)))
    profiling.shape_states(lines, "batch").write.parquet(path)
    states = spark.read.parquet(path)
    before = profiling.merged_shapes(states.filter("batch < 3"))
    after = profiling.merged_shapes(states.filter("batch >= 3"))
    return profiling.schema_drift(before, after)


# --- streams --------------------------------------------------------------


@query
def stream_ingest(spark: SparkSession, root: str) -> DataFrame:
    path = scratch_path(spark, "ingest")
    files.write_topic(event_posts.envelopes(spark, root), f"{path}/topic", packed=True)
    lines = topics.stream_topic(
        spark, f"{path}/topic", max_files=TOPIC_FILES, acknowledge=True
    )
    ingest.start_ingest(lines, f"{path}/out", f"{path}/checkpoint").awaitTermination()
    archive = files.read_json_archive(spark, f"{path}/out/json")
    hours = files.read_hour_partitions(spark, f"{path}/out/parquet", STORED)
    table = files.read_appended(spark, f"{path}/out/table", STORED)
    letters = spark.read.parquet(f"{path}/out/dead_letters")

    def rows(store: str, df: DataFrame, content: str, place: Column) -> DataFrame:
        return df.select(
            F.lit(store).alias("store"),
            "message_id",
            F.col(content).alias("content"),
            place.alias("place"),
        )

    hour = F.concat_ws("-", "year", "month", "day", "hour")
    cause = F.concat_ws("/", "failed_stage", "error_reason")
    return (
        rows("json", archive, "json", F.lit("json"))
        .unionByName(rows("parquet", hours, "title", hour))
        .unionByName(rows("table", table, "title", F.lit("table")))
        .unionByName(rows("dead_letters", letters, "raw", cause))
    )


@query
def stream_ingest_committed(spark: SparkSession, root: str) -> DataFrame:
    path = scratch_path(spark, "committed")
    out = f"{path}/out"
    files.write_topic(event_posts.envelopes(spark, root), f"{path}/topic", packed=True)
    # The batches of another run reach two stores and die before their commit.
    names = topics.topic_files(spark, f"{path}/topic")
    for number, start in enumerate(range(0, len(names), TOPIC_FILES)):
        topic = topics.read_topic(spark, names[start : start + TOPIC_FILES])
        own = files.Batch("lost", number)
        # Its messages are parsed once, as those of a stream's batch are.
        flat = landing.flattened(landing.stored(landing.receive(topic)))
        flat = flat.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            lost = landing.unflattened(flat)
            files.write_json_archive(lost, f"{out}/json", own)
            table = lost.select("message_id", "post.*", "landed_at", "position")
            files.append_table(table, f"{out}/table", own)
        finally:
            flat.unpersist()
    lines = topics.stream_topic(
        spark, f"{path}/topic", max_files=TOPIC_FILES, acknowledge=True
    )
    ingest.start_committed_ingest(lines, out, f"{path}/checkpoint").awaitTermination()

    def rows(store: str, content: str, place: Column) -> DataFrame:
        return commits.read_committed(spark, out, store).select(
            F.lit(store).alias("store"),
            "message_id",
            F.col(content).alias("content"),
            place.alias("place"),
        )

    return (
        rows("json", "json", F.lit("json"))
        .unionByName(rows("parquet", "title", F.concat_ws("-", "year", "month", "day", "hour")))
        .unionByName(rows("table", "title", F.lit("table")))
        .unionByName(rows("dead_letters", "raw", F.concat_ws("/", "failed_stage", "error_reason")))
    )


def _write_ranges(spark: SparkSession, rows: DataFrame, path: str, least: int, *order: str) -> int:
    """Write rows in ranges of ``order``; the number of files.

    There are as many ranges as a shuffle has, and no fewer than the size of the input asks
    for: ranges hold like numbers of rows, of which those with long texts may lie together.
    """
    shuffled = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = file_bytes(spark, rows.inputFiles())
    parts = max(least, shuffled, -(-size // RANGE_BYTES))
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    dealt.write.parquet(path)
    return len(spark.read.schema(rows.schema).parquet(path).inputFiles())


def _batches_by_time(spark: SparkSession, rows: DataFrame, path: str, batches: int) -> DataFrame:
    """A stream of rows by ranges of arrival, in so many micro-batches.

    A micro-batch holds many files, so that no task reads a large part of the topic. The
    source takes files by age: tasks that write at once may end in another order.
    """
    written = _write_ranges(spark, rows, path, batches, "seq")
    each = max(1, -(-written // batches))
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", each).parquet(path)


@query
def stream_object_latest(spark: SparkSession, root: str) -> DataFrame:
    path = scratch_path(spark, "objects")
    fields = ["seq", "question_id", "message_id", "score", "creation_date"]
    rows = event_posts.captures(spark, root).select(*fields)
    stream = _batches_by_time(spark, rows, f"{path}/topic", 3)
    ingest.run_batches(
        stream,
        lambda batch, own: objects.upsert_objects(batch, f"{path}/objects", ("seq",)),
        f"{path}/checkpoint",
    ).awaitTermination()
    held = objects.read_objects(spark, f"{path}/objects", rows.schema)
    hour = pf.hour_path(F.col("creation_date"))
    return held.select(hour.alias("hour_path"), "question_id", "message_id", "score")


@query
def gold_incremental(spark: SparkSession, root: str) -> DataFrame:
    path = scratch_path(spark, "incremental")
    rows = event_posts.posts(spark, root).select(
        "seq", "question_id", "title", "owner", "score", "answer_count",
        "creation_date", "last_activity_date", "message_id",
    )
    stream = _batches_by_time(spark, rows, f"{path}/topic", 3)
    ingest.run_batches(
        stream,
        lambda batch, own: incremental.refresh_gold(batch, f"{path}/gold", own),
        f"{path}/checkpoint",
    ).awaitTermination()
    return incremental.read_gold(spark, f"{path}/gold")


@query
def authors_by_range(spark: SparkSession, root: str) -> DataFrame:
    """Distinct authors of the seven days that end with each day, and of all days."""
    path = scratch_path(spark, "authors")
    day = pf.epoch_day(F.col("creation_date"))
    rows = _silver(spark, root).select(day.alias("report_date"), "sentiment", "author")
    rows.write.parquet(f"{path}/silver")
    rows = spark.read.schema(rows.schema).parquet(f"{path}/silver")
    numbers = distinct.new_numbers(rows, "author")
    numbers.write.parquet(f"{path}/dictionary")
    dictionary = spark.read.schema(numbers.schema).parquet(f"{path}/dictionary")
    maps = distinct.bitmaps(rows, ["report_date", "sentiment"], "author", dictionary)
    maps.write.parquet(f"{path}/bitmaps")
    maps = spark.read.schema(maps.schema).parquet(f"{path}/bitmaps")
    days = rows.select("report_date").where("report_date IS NOT NULL").distinct()
    ranges = days.select(
        F.date_sub("report_date", 6).alias("first_day"), F.col("report_date").alias("last_day")
    ).unionByName(
        days.agg(F.min("report_date").alias("first_day"), F.max("report_date").alias("last_day"))
    )
    found = distinct.count_by_range(maps, ranges, "report_date")
    return found.select("first_day", "last_day", F.col("values").alias("authors"))


def _timed_messages(spark: SparkSession, root: str) -> DataFrame:
    rows = event_posts.messages(spark, root)
    return rows.select("seq", "message_id", "publish_ts", "value", "attributes")


@query
def stream_fanout(spark: SparkSession, root: str) -> DataFrame:
    path = scratch_path(spark, "fanout")
    stream = _batches_by_time(spark, _timed_messages(spark, root), f"{path}/topic", 4)
    started = subscriptions.start_fan_out(
        stream, SUBSCRIPTIONS, f"{path}/out", f"{path}/checkpoints"
    )
    for own in started.values():
        own.awaitTermination()
    copies = [
        spark.read.schema(stream.schema)
        .parquet(f"{path}/out/{name}")
        .select(F.lit(name).alias("subscription"), "message_id", F.length("value").alias("chars"))
        for name in started
    ]
    return functools.reduce(DataFrame.unionByName, copies)


@query
def stream_subscription_start(spark: SparkSession, root: str) -> DataFrame:
    path = scratch_path(spark, "start")
    rows = _timed_messages(spark, root)
    # Messages of one time may go to several files.
    _write_ranges(spark, rows, f"{path}/topic", 8, "publish_ts", "seq")
    subscriptions.index_topic(spark, f"{path}/topic", rows.schema, f"{path}/index")
    subscriptions.start_from_time(
        spark, f"{path}/index", rows.schema, SUBSCRIPTIONS[2], f"{path}/out", f"{path}/checkpoint"
    ).awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{path}/out").select("message_id", "seq")


@query
def stream_archive_latest(spark: SparkSession, root: str) -> DataFrame:
    path = scratch_path(spark, "latest")
    envelopes = event_posts.envelopes(spark, root)
    # Every message comes twice, first with another title to a stream of its own.
    files.write_topic(envelopes, f"{path}/topic", packed=True)

    def archive(batch: DataFrame, own: files.Batch, older: bool) -> None:
        posts = landing.stored(landing.receive(batch))
        if older:
            posts = posts.withColumn("post", F.col("post").withField("title", F.lit("older")))
        files.write_json_archive(posts, f"{path}/json", own)

    for run in ("first", "second"):
        lines = topics.stream_topic(
            spark, f"{path}/topic", max_files=TOPIC_FILES, acknowledge=run == "second"
        )
        ingest.run_batches(
            lines, functools.partial(archive, older=run == "first"), f"{path}/{run}"
        ).awaitTermination()
    return files.latest_archive(spark, f"{path}/json")


def _routed_stream(spark: SparkSession, root: str) -> DataFrame:
    path = scratch_path(spark, "routing")
    # The topic's lines carry no message id, so the rows have none either.
    files.write_topic(event_posts.messages(spark, root), f"{path}/topic")
    lines = topics.stream_topic(spark, f"{path}/topic", max_files=4)
    lines = lines.withColumn("message_id", F.lit(None).cast("string"))
    ingest.start_routing(lines, f"{path}/out", f"{path}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{path}/out")


@query
def stream_dead_letters(spark: SparkSession, root: str) -> DataFrame:
    letters = ingest.routed_letters(_routed_stream(spark, root))
    return letters.select("raw", "error_reason", "failed_stage", "source")


@query
def stream_routing(spark: SparkSession, root: str) -> DataFrame:
    written = _routed_stream(spark, root)
    return written.groupBy("route", "reason").agg(F.count("*").alias("messages"))


def _deliveries(spark: SparkSession, root: str, path: str) -> DataFrame:
    """A stream of messages in which every fifth or so comes twice."""
    rows = event_posts.messages(spark, root).select(
        "message_id", "publish_ts", "value", "k"
    )
    # Redeliveries go to other files than first deliveries, whose files they come from.
    rows.write.mode("append").parquet(path)
    first = spark.read.schema(rows.schema).parquet(path)
    first.filter(F.col("k") >= 80).write.mode("append").parquet(path)
    schema = rows.drop("k").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 8).parquet(path)


@query
def stream_dedup(spark: SparkSession, root: str) -> DataFrame:
    path = scratch_path(spark, "dedup")
    stream = _deliveries(spark, root, f"{path}/topic")
    # The delay covers the whole time span of the topic's files.
    once = ingest.drop_redelivered(stream, delay="60 days")
    (
        once.writeStream.format("parquet")
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{path}/out")
        .awaitTermination()
    )
    return spark.read.parquet(f"{path}/out").select("message_id", "value")


@query
def stream_first_deliveries(spark: SparkSession, root: str) -> DataFrame:
    path = scratch_path(spark, "first")
    stream = _deliveries(spark, root, f"{path}/topic")
    ingest.start_first_deliveries(
        stream, f"{path}/out", f"{path}/checkpoint"
    ).awaitTermination()
    return spark.read.parquet(f"{path}/out").select("message_id", "value")
