import math

import pytest
from pyspark.sql import types as T

from recordwise.operators import quality

pytestmark = pytest.mark.literal


def metrics(report):
    return {(r["check"], r["column"], r["metric"]): (r["value"], r["is_valid"]) for r in report.collect()}


def test_completeness_of_rows_and_of_nothing(spark):
    df = spark.createDataFrame([(1, None), (2, "b"), (3, None)], "id int, `a.b` string")
    got = metrics(quality.completeness(df))
    assert got["completeness", "a.b", "null_count"] == (2.0, None)
    assert got["completeness", "a.b", "completeness_percentage"] == (33.33, None)
    assert got["completeness", "id", "completeness_percentage"] == (100.0, None)
    empty = metrics(quality.completeness(df.where("id > 9")))
    assert empty["completeness", "id", "completeness_percentage"] == (0.0, None)


def test_uniqueness_counts_null_once(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,)], "id int")
    got = metrics(quality.uniqueness(df, ["id"]))
    assert got["uniqueness", "id", "distinct_count"] == (2.0, False)
    assert got["uniqueness", "id", "duplicate_count"] == (2.0, False)
    assert metrics(quality.uniqueness(df.where("id = 9"), ["id"]))["uniqueness", "id", "total_count"] == (0.0, True)


def test_ranges_and_patterns_ignore_null(spark):
    df = spark.createDataFrame([(-1.0, "ab"), (5.0, "x'y"), (11.0, None), (None, "AB")], "v double, t string")
    got = metrics(quality.run_checks(df, [
        quality.range_check("v", 0, 10), quality.range_check("absent", 0, 1), quality.range_check("v", None, 20),
        quality.pattern_check("t", r"^[a-z'\w]+$")]))
    assert got["range", "v", "violations_above_max"][0] in (0.0, 1.0)
    assert got["pattern", "t", "matching_pattern"] == (3.0, None)
    assert not [k for k in got if k[1] == "absent"]
    strict = metrics(quality.run_checks(df, [quality.range_check("v", 0, 10)]))
    assert strict["range", "v", "violations_below_min"] == (1.0, False)
    assert strict["range", "v", "max_value"] == (11.0, False)


def test_references_leave_null_out_and_count_it(spark):
    df = spark.createDataFrame([("a",), ("a",), ("z",), (None,)], "k string")
    got = metrics(quality.references_in_list(df, "k", ["a", None, "b"]))
    assert got["reference", "k", "invalid_references"] == (1.0, False)
    assert got["reference", "k", "null_references"] == (1.0, False)
    assert got["reference", "k", "valid_percentage"] == (75.0, False)


def test_rules_and_health(spark):
    df = spark.createDataFrame([(1, 5.0, 9.0, 12.0, "2030-01-01"), (2, 5.0, 2.0, 5.0, "")],
                               "id int, budget_musd double, revenue_musd double, vote_average double, release_date string")
    report = quality.quality_report(df, "2025-01-01", ranges={"budget_musd": {"min": 0}})
    got = metrics(report)
    assert got["rule", "revenue_vs_budget", "violations"] == (1.0, False)
    assert got["rule", "vote_average_range", "violations"] == (1.0, False)
    assert got["rule", "future_release_dates", "violations"] == (1.0, False)
    health = quality.health_score(report).first()
    assert (health["checks"], health["passed"], health["health_score"], health["healthy"]) == (5, 2, 40.0, False)
    assert quality.health_score(report, 30).first()["healthy"]
    rules = [c.column for c in quality.record_rules(["vote_average"], "2025-01-01")]
    assert rules == ["vote_average_range"]


def test_outliers_leave_out_constant_columns(spark):
    rows = [(float(i % 10), 1.0, None) for i in range(100)] + [(1000.0, 1.0, None)]
    df = spark.createDataFrame(rows, "v double, constant double, unknown double")
    found = quality.outliers(df).collect()
    assert [(r["column"], r["outliers"]) for r in found] == [("v", 1)]
    values = [r[0] for r in rows]
    mean = sum(values) / len(values)
    assert found[0]["stddev"] == pytest.approx(math.sqrt(sum((v - mean) ** 2 for v in values) / (len(values) - 1)))


def test_schema_check(spark):
    df = spark.createDataFrame([(1, "x")], "id int, extra string")
    expected = T.StructType.fromDDL("id bigint, title string")
    rows = {(r["problem"], r["column"], r["rows"] == r["wrong"]) for r in quality.schema_check(df, expected).collect()}
    assert rows == {("missing", "title", True), ("extra", "extra", False), ("type", "id", False)}
    assert [(r["problem"], r["wrong"]) for r in quality.schema_check(df, df.schema).collect()] == [(None, 0)] * len(df.columns)


def test_null_rows_and_declared_checks(spark):
    df = spark.createDataFrame([(1, None, None), (2, "x", None)], "id int, a string, b string")
    assert [r["id"] for r in quality.rows_with_many_nulls(df, 1).collect()] == [1]
    assert {r["column"]: r["null_count"] for r in quality.null_counts(df).collect()} == {"id": 0, "a": 1, "b": 2}
    with pytest.raises(ValueError):
        quality.declared_checks(df, [{"name": "unknown", "column": "id"}])


def test_all_counting_checks_share_one_aggregation(spark):
    df = spark.range(10).selectExpr("id", "id as a", "id as b", "id as c")
    checks = [quality.completeness_check(c) for c in df.columns] + [quality.range_check(c, 0, 5) for c in df.columns]
    plan = quality.run_checks(df, checks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1 and plan.count("Exchange") == 1


def test_schema_check_of_nested_columns(spark):
    df = spark.createDataFrame([((1,), [1], "7", {"a": 1}), (None, None, "x", None)], "s struct<a: int>, l array<int>, t string, m map<string, int>")
    expected = T.StructType([T.StructField(name, T.IntegerType()) for name in "sltm"])
    found = {r["column"]: (r["problem"], r["rows"], r["wrong"]) for r in quality.schema_check(df, expected).collect()}
    assert found == {"s": ("type", 2, 1), "l": ("type", 2, 1), "t": ("type", 2, 1), "m": ("type", 2, 1)}
    nested = T.StructType([T.StructField("t", T.ArrayType(T.IntegerType()))])
    assert quality.schema_check(df.select("t"), nested).first()["wrong"] == 2
