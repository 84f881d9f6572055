"""Check suites and schema profiles."""

from __future__ import annotations

from postloom.operators import profiling, quality


def results(spark, checks, rows, schema):
    df = spark.createDataFrame(rows, schema)
    found = quality.run_suite(df, checks, "t", "run-1").collect()
    return {(r["check_name"], r["column_name"]): (r["observed"], r["passed"]) for r in found}


def test_suite(spark):
    rows = [(1, "ab", "x"), (1, None, "y"), (None, "abcdef", None), (2, "", "z")]
    found = results(
        spark,
        [
            quality.row_count(low=1, high=4),
            quality.column_exists("id"),
            quality.column_exists("gone"),
            quality.not_null("gone"),
            quality.unique("id"),
            quality.unique("name"),
            quality.not_null("id"),
            quality.null_ratio("name", 0.25),
            quality.length_between("name", 1, 5),
            quality.in_set("kind", ["x", "y"]),
        ],
        rows,
        "id int, name string, kind string",
    )
    assert found == {
        ("row_count", None): (4.0, True),
        ("column_exists", "id"): (1.0, True),
        ("column_exists", "gone"): (0.0, False),
        ("not_null", "gone"): (None, False),
        ("unique", "id"): (1.0, False),
        ("unique", "name"): (0.0, True),
        ("not_null", "id"): (1.0, False),
        ("null_ratio", "name"): (0.25, True),
        ("length_between", "name"): (2.0, False),
        ("in_set", "kind"): (1.0, False),
    }


def test_suite_of_unique_checks_alone_and_empty_table(spark):
    assert results(spark, [quality.unique("id")], [(1,), (1,)], "id int") == {
        ("unique", "id"): (1.0, False)
    }
    assert results(spark, [quality.row_count(low=1)], [], "id int") == {
        ("row_count", None): (0.0, False)
    }


def test_duplicated(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,), (None,)], "id int")
    assert [tuple(r) for r in quality.duplicated(df, "id").collect()] == [(1, 3)]


def lines(spark):
    texts = ['{"a": 1, "b": {"c": [1, "x", {"d": null}]}}', '{"a": "s"}', "[1]", "bad"]
    return spark.createDataFrame([(text,) for text in texts], "value string")


def test_key_presence(spark):
    rows = profiling.key_presence(lines(spark)).collect()
    found = {r["key"]: (r["records"], r["share"]) for r in rows}
    assert found == {"a": (2, 1.0), "b": (1, 0.5)}


def test_field_types(spark):
    found = {tuple(r) for r in profiling.field_types(lines(spark), ["a", "b"]).collect()}
    assert found == {
        ("a", "int", 1), ("a", "str", 1), ("a", "NoneType", 1),
        ("b", "dict", 1), ("b", "NoneType", 2),
    }


def test_schema_paths(spark):
    found = {tuple(r) for r in profiling.schema_paths(lines(spark)).collect()}
    assert found == {
        ("$", "dict", 2), ("$", "list", 1), ("$[]", "int", 1),
        ("$.a", "int", 1), ("$.a", "str", 1), ("$.b", "dict", 1),
        ("$.b.c", "list", 1), ("$.b.c[]", "int", 1), ("$.b.c[]", "str", 1),
        ("$.b.c[]", "dict", 1), ("$.b.c[].d", "NoneType", 1),
    }
    shallow = {(r["path"], r["type"]) for r in profiling.schema_paths(lines(spark), depth=1).collect()}
    assert {path for path, kind in shallow if kind != "..."} == {"$", "$[]", "$.a", "$.b"}
    assert {path for path, kind in shallow if kind == "..."} == {"$.b.c"}


def test_shapes_and_merged_schema(spark):
    df = spark.createDataFrame(
        [('{"a": 1}',), ('{"a": 2}',), ('{"a": 1, "b": "x"}',)], "value string"
    )
    shapes = {tuple(r) for r in profiling.record_shapes(df).collect()}
    assert shapes == {("OBJECT<a: BIGINT>", 2), ("OBJECT<a: BIGINT, b: STRING>", 1)}
    merged = profiling.schema_merged(df).first()
    assert tuple(merged) == ("dict", "OBJECT<a: BIGINT, b: STRING>", 3)
