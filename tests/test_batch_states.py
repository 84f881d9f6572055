"""State that goes from batch to batch: positions, check sums, shapes, versions."""

from __future__ import annotations

import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postloom.operators import messaging, profiling, quality
from postloom.operators.versions import Version, conflicts, resolve
from postloom.sinks import checked, files
from postloom.streaming import positions

KEYED = "seq long, key string"


def _keyed(spark, path, low, high):
    rows = [(i, None if i % 11 == 0 else "hot" if i % 3 else f"k{i % 5}") for i in range(low, high)]
    spark.createDataFrame(rows, KEYED).coalesce(1).write.mode("append").parquet(path)
    return rows


@pytest.mark.parametrize("every", [2, 20])
def test_positions_go_on_over_batches(spark, scratch, monkeypatch, every):
    rows = []

    def run():
        stream = spark.readStream.schema(KEYED).option("maxFilesPerTrigger", 1)
        return positions.start_keyed_order(
            stream.parquet(f"{scratch}/topic"), f"{scratch}/out", f"{scratch}/c", every=every
        )

    for low in range(0, 100, 20):
        rows += _keyed(spark, f"{scratch}/topic", low, low + 20)
    # The third batch dies after its rows and counts were written, before its batch ends.
    whole, calls = positions.counts_before, []

    def dying(session, root, own, size):
        calls.append(own.number)
        if calls.count(3) == 1 and own.number == 3:
            raise RuntimeError("lost")
        return whole(session, root, own, size)

    monkeypatch.setattr(positions, "counts_before", dying)
    with pytest.raises(StreamingQueryException, match="lost"):
        run().awaitTermination()
    run().awaitTermination()
    rows += _keyed(spark, f"{scratch}/topic", 100, 130)
    run().awaitTermination()
    names = ["seq", "key", "partition", "offset", "key_position"]
    expected = messaging.keyed_order(spark.createDataFrame(rows, KEYED)).select(*names)
    found = spark.read.parquet(f"{scratch}/out/rows").select(*names)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)


def test_a_batch_that_is_run_again_replaces_its_counts(spark, scratch):
    own = files.Batch("r", 1)
    rows = spark.createDataFrame([(0, "a"), (1, "a")], KEYED)
    before = spark.createDataFrame([(0, "a", 5), (1, "a", 5), (2, "a", 5), (0, None, 7)], "partition int, key string, messages long")
    for _ in range(2):
        placed = positions.continued(rows, before)
        placed.groupBy("partition", "key").agg(F.count("*").alias("messages")).write.mode(
            "overwrite"
        ).parquet(files.batch_folder(f"{scratch}/counts", own))
    found = {(r["seq"], r["key_position"]) for r in placed.collect()}
    assert found == {(0, 5), (1, 6)}
    total = positions.counts_before(spark, scratch, files.Batch("r", 2))
    assert [r["messages"] for r in total.collect()] == [2]


CHECKS = [
    quality.row_count(low=3),
    quality.column_exists("title"),
    quality.column_exists("absent"),
    quality.not_null("id"),
    quality.null_ratio("title", 0.3),
    quality.null_ratio("absent", 0.3),
    quality.length_between("title", 1, 3),
    quality.length_between("title", 2, 9),
    quality.in_set("title", ["a", "bb"]),
]


def test_checks_of_batches_add_up(spark, scratch):
    batches = [
        [(1, "a"), (2, None), (None, "dddd")],
        [],
        [(4, "bb"), (5, ""), (6, None)],
    ]
    for number, rows in enumerate(batches):
        own = files.Batch("run", number)
        frame = spark.createDataFrame(rows, "id long, title string")
        for _ in range(2):  # the second attempt replaces the first
            checked.write_checked(
                frame, CHECKS, f"{scratch}/states", own,
                lambda out: files.append_table(out, f"{scratch}/table", own),
            )
    found = checked.merged_results(spark, CHECKS, f"{scratch}/states", "t", "r")
    whole = spark.read.parquet(f"{scratch}/table")
    expected = quality.run_suite(whole.select("id", "title"), CHECKS, "t", "r")
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
    with pytest.raises(ValueError, match="added up"):
        checked.write_checked(whole, [quality.unique("id")], scratch, own, lambda out: None)


def test_checking_takes_no_scan_of_its_own(spark, scratch):
    spark.range(100).selectExpr("id", "'a' AS title").write.parquet(f"{scratch}/in")
    plans = []

    def write(out):
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        out.write.parquet(f"{scratch}/out")

    checked.write_checked(
        spark.read.parquet(f"{scratch}/in"), CHECKS, f"{scratch}/states", files.Batch("r", 0), write
    )
    assert plans[0].count("FileScan") == 1 and "CollectMetrics" in plans[0]
    assert "Aggregate" not in plans[0] and "Exchange" not in plans[0]


def test_drift_of_shapes(spark):
    def state(*records):
        lines = spark.createDataFrame([(json.dumps(r), i) for i, r in enumerate(records)], "value string, batch int")
        states = profiling.shape_states(lines, "batch")
        merged = profiling.merged_shapes(states)
        whole = profiling.schema_paths(lines)
        assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, whole.collect()))
        return merged

    before = state({"a": 1, "b": "x", "c": None, "e": [1]}, {"a": 1, "c": 2})
    after = state({"a": 1, "b": "x", "d": {"f": True}, "e": ["y"]}, {"b": 3, "c": 2})
    found = {r["path"]: tuple(r)[1:] for r in profiling.schema_drift(before, after).collect()}
    assert found == {
        "$.b": ("widened", "str", "int|str"),
        "$.c": ("narrowed", "NoneType|int", "int"),
        "$.d": ("new", None, "dict"),
        "$.d.f": ("new", None, "bool"),
        "$.e[]": ("changed", "int", "str"),
    }
    assert profiling.schema_drift(before, before).collect() == []


INT, LONG, DOUBLE, TEXT = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()


def _version(name, *fields, **defaults):
    return Version(name, T.StructType([T.StructField(*f) for f in fields]), defaults)


OLD = _version("v1", ("id", INT, False), ("score", INT), ("link", TEXT))
NEW = _version("v2", ("id", LONG, False), ("score", DOUBLE), ("tags", T.ArrayType(TEXT)), tags=["none"])


def test_versions_are_resolved(spark):
    rows = [
        ("v1", '{"id": 1, "score": 2, "link": "l"}'),
        ("v1", '{"id": 1, "score": 3000000000}'),
        ("v1", '{"score": 2}'),
        ("v2", '{"id": 3000000000, "score": 2.5, "tags": ["x"], "more": 1}'),
        ("v2", '{"id": null, "score": 1}'),
        ("v2", "not json"),
        ("v2", None),
        ("v3", '{"id": 1}'),
        (None, '{"id": 1}'),
    ]
    messages = spark.createDataFrame(rows, "version string, value string").select(
        "value", F.create_map(F.lit("schema_version"), "version").alias("attributes")
    )
    found = resolve(messages, [OLD, NEW], NEW).collect()
    assert [(r["reason"], r["post"] and tuple(r["post"])) for r in found] == [
        (None, (1, 2.0, ["none"])),
        ("bad_type", None),
        ("missing: id", None),
        (None, (3_000_000_000, 2.5, ["x"])),
        ("missing: id", None),
        ("bad_json", None),
        ("missing: id", None),
        ("unknown_version", None),
        ("unknown_version", None),
    ]


def test_versions_that_do_not_fit_are_refused(spark):
    assert conflicts(OLD, NEW) == []
    assert conflicts(NEW, OLD) == ["id: bigint to int", "score: double to int"]
    strict = _version("v3", ("id", LONG, False), ("owner", TEXT, False))
    assert conflicts(OLD, strict) == ["owner: not in v1, and without a default"]
    frame = spark.createDataFrame([("{}", {"schema_version": "v1"})], "value string, attributes map<string,string>")
    with pytest.raises(ValueError, match="owner"):
        resolve(frame, [OLD], strict)


def test_lookup_skips_row_groups(spark, scratch):
    rows = spark.range(0, 20_000, 2).selectExpr(
        "id AS question_id", "1763996420 + (id % 4) * 3600 AS creation_date", "repeat('x', 50) AS title"
    )
    files.write_hour_partitions(rows, scratch)
    one = files.lookup_questions(spark, scratch, rows.schema, [4_002])
    assert [r["question_id"] for r in one.collect()] == [4_002]
    # Within the bounds of every file and in none of them: no row group is read.
    none = files.lookup_questions(spark, scratch, rows.schema, [4_001])
    none.collect()
    plan = none._jdf.queryExecution().executedPlan()
    assert "question_id" in plan.toString().split("PushedFilters")[1].split("]")[0]
    assert plan.collectLeaves().head().metrics().apply("numOutputRows").value() == 0
