"""Data quality checks as report rows: check, column, metric, value, is_valid.

All checks that only count rows share one aggregation over one scan. Only uniqueness,
references and outliers need more: a shuffle of one narrow column, a join, or the mean
and deviation of the columns.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


REPORT_SCHEMA = "check string, column string, metric string, value double, is_valid boolean"
NUMERIC = (T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
MIN_HEALTH_SCORE = 80.0


@dataclass
class Check:
    """Aggregates by metric name, values derived from them, and the condition to pass.

    All expressions are SQL; ``derived`` and ``valid`` may use the metric names.
    """

    check: str
    column: str
    aggregates: dict[str, str]
    derived: dict[str, str] = field(default_factory=dict)
    valid: str | None = None


def quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def text(value: str) -> str:
    """SQL literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def completeness_check(column: str) -> Check:
    c = quoted(column)
    return Check(
        "completeness",
        column,
        {"total_rows": "count(1)", "null_count": f"count(1) - count({c})", "non_null_count": f"count({c})"},
        {"completeness_percentage": "coalesce(round(try_divide(non_null_count * 100, total_rows), 2), 0)"},
    )


def null_check(column: str) -> Check:
    c = quoted(column)
    return Check("null", column, {"null_count": f"count(1) - count({c})"}, valid="null_count = 0")


def range_check(column: str, low: float | None = None, high: float | None = None) -> Check:
    c = quoted(column)
    return Check(
        "range",
        column,
        {
            "min_value": f"min({c})",
            "max_value": f"max({c})",
            "violations_below_min": "count_if(false)" if low is None else f"count_if({c} < {low})",
            "violations_above_max": "count_if(false)" if high is None else f"count_if({c} > {high})",
        },
        valid="violations_below_min = 0 and violations_above_max = 0",
    )


def pattern_check(column: str, pattern: str) -> Check:
    c = quoted(column)
    return Check(
        "pattern",
        column,
        {"total_non_null": f"count({c})", "matching_pattern": f"count_if(rlike({c}, {text(pattern)}))"},
        {
            "not_matching": "total_non_null - matching_pattern",
            "match_percentage": "coalesce(round(try_divide(matching_pattern * 100, total_non_null), 2), 0)",
        },
    )


def rule_check(name: str, violation: str) -> Check:
    """Business rule: no row may satisfy the SQL predicate ``violation``."""
    return Check("rule", name, {"violations": f"count_if({violation})"}, valid="violations = 0")


def record_rules(columns: Sequence[str], as_of: str | None = None) -> list[Check]:
    """The three rules of the record model, each only where its columns exist.

    ``as_of`` is the day that counts as today, for repeatable reports.
    """
    today = f"date'{as_of}'" if as_of else "current_date()"
    rules = [
        ({"revenue_musd", "budget_musd"}, "revenue_vs_budget",
         "revenue_musd > 0 and budget_musd > 0 and revenue_musd < budget_musd"),
        ({"vote_average"}, "vote_average_range", "vote_average < 0 or vote_average > 10"),
        ({"release_date"}, "future_release_dates",
         f"try_cast(release_date as date) > {today}"),
    ]
    return [rule_check(name, sql) for needed, name, sql in rules if needed <= set(columns)]


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Report rows of many counting checks from a single aggregation of ``df``.

    Checks on a column that does not exist are skipped.
    """
    checks = [c for c in checks if c.check == "rule" or c.column in df.columns]
    if not checks:
        return df.sparkSession.createDataFrame([], REPORT_SCHEMA)
    names: dict[str, str] = {}  # one aggregate per distinct expression
    for check in checks:
        for sql in check.aggregates.values():
            names.setdefault(sql, f"a{len(names)}")
    derived, entries = [], []
    for i, check in enumerate(checks):
        local = {metric: names[sql] for metric, sql in check.aggregates.items()}
        for metric, sql in check.derived.items():
            derived.append(f"{_substitute(sql, local)} as d{i}_{metric}")
            local[metric] = f"d{i}_{metric}"
        valid = _substitute(check.valid, local) if check.valid else "cast(null as boolean)"
        entries += [_entry(check.check, check.column, metric, name, valid) for metric, name in local.items()]
    one_row = df.selectExpr(*[f"{sql} as {name}" for sql, name in names.items()])
    return one_row.selectExpr("*", *derived).selectExpr(_rows(entries))


def _substitute(sql: str, local: Mapping[str, str]) -> str:
    return re.sub(r"\w+", lambda word: local.get(word[0], word[0]), sql)


def _entry(check: str, column: str, metric: str, value: str, valid: str) -> str:
    """One report row as SQL. Reports have hundreds of rows; as text they are built at once."""
    return (
        f"named_struct('check', {text(check)}, 'column', {text(column)}, 'metric', {text(metric)}, "
        f"'value', cast({value} as double), 'is_valid', {valid})"
    )


def _rows(entries: Sequence[str]) -> str:
    return f"inline(array({', '.join(entries)}))"


def completeness(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return run_checks(df, [completeness_check(c) for c in columns or df.columns])


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column with its number of NULLs, from one scan."""
    columns = columns or df.columns
    counts = df.agg(*[(F.count(F.lit(1)) - F.count(F.col(quoted(c)))).alias(c) for c in columns])
    return counts.unpivot([], columns, "column", "null_count")


def uniqueness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Total, distinct and duplicate counts per column; NULL counts as one value.

    Each column is reduced to its distinct values before the shuffle and read on its own,
    so no other column travels with it.
    """
    def one(column: str) -> DataFrame:
        counts = df.groupBy(F.col(quoted(column)).alias("value")).agg(F.count(F.lit(1)).alias("copies"))
        totals = counts.selectExpr("coalesce(sum(copies), 0) as total", "count(1) as distinct_values")
        metrics = {
            "total_count": "total",
            "distinct_count": "distinct_values",
            "duplicate_count": "total - distinct_values",
        }
        rows = [_entry("uniqueness", column, m, v, "total = distinct_values") for m, v in metrics.items()]
        return totals.selectExpr(_rows(rows))

    return reduce(DataFrame.unionByName, [one(c) for c in columns])


def references(df: DataFrame, column: str, valid: DataFrame, valid_column: str | None = None) -> DataFrame:
    """Count rows whose ``column`` is missing from the values of ``valid``.

    NULL is not an invalid reference; it is counted on its own. Rows are first counted per
    value, so a value that many rows share is joined once.
    """
    valid_column = valid_column or valid.columns[0]
    counted = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("copies"))
    known = valid.select(F.col(valid_column).alias("known")).where(F.col("known").isNotNull()).distinct()
    marked = counted.join(
        known.withColumn("found", F.lit(True)), counted["value"] == F.col("known"), "left"
    )
    totals = marked.selectExpr(
        "coalesce(sum(copies), 0) as total",
        "coalesce(sum(case when found is null and value is not null then copies end), 0) as invalid",
        "coalesce(sum(case when value is null then copies end), 0) as nulls",
    )
    metrics = {
        "total_rows": "total",
        "invalid_references": "invalid",
        "null_references": "nulls",
        "valid_percentage": "coalesce(round(try_divide((total - invalid) * 100, total), 2), 0)",
    }
    return totals.selectExpr(_rows([_entry("reference", column, m, v, "invalid = 0") for m, v in metrics.items()]))


def references_in_list(df: DataFrame, column: str, allowed: Sequence) -> DataFrame:
    """``references`` against a literal list."""
    values = df.sparkSession.createDataFrame(
        [(v,) for v in allowed], T.StructType([T.StructField("known", df.schema[column].dataType)])
    )
    return references(df, column, values)


def schema_differences(df: DataFrame, expected: T.StructType) -> list[tuple[str, str, str | None, str | None]]:
    """Missing, extra and wrongly typed columns, from the schemas alone."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    wanted = {f.name: f.dataType for f in expected.fields}
    rows = [("missing", n, t.simpleString(), None) for n, t in wanted.items() if n not in actual]
    rows += [("extra", n, None, t.simpleString()) for n, t in actual.items() if n not in wanted]
    rows += [
        ("type", n, t.simpleString(), actual[n].simpleString())
        for n, t in wanted.items()
        if n in actual and actual[n] != t
    ]
    return rows


def schema_check(df: DataFrame, expected: T.StructType) -> DataFrame:
    """How many rows fit the expected type, one row per expected or extra column, in one scan.

    ``rows`` counts all rows, ``wrong`` those whose value does not convert to the expected type; for a
    missing column all rows are wrong, for an extra one none. Where no conversion exists between the two types,
    as from a struct to a number, every known value is wrong.
    """
    differences = {name: problem for problem, name, *_ in schema_differences(df, expected)}
    wanted = {f.name: f.dataType.simpleString() for f in expected.fields}
    extra = [n for n, problem in differences.items() if problem == "extra"]

    def converts(name: str) -> bool:
        try:
            df.selectExpr(f"try_cast({quoted(name)} as {wanted[name]})")  # analysed, not run
        except AnalysisException as error:
            if not (error.getCondition() or "").startswith("DATATYPE_MISMATCH"):
                raise
            return False
        return True

    def wrong(name: str) -> str:
        problem = differences.get(name)
        if problem == "missing":
            return "count(1)"
        if problem != "type":
            return "0L"
        known = f"{quoted(name)} is not null"
        return f"count_if({known} and try_cast({quoted(name)} as {wanted[name]}) is null)" if converts(name) else f"count_if({known})"

    entries = [
        f"named_struct('column', {text(n)}, 'expected', {text(wanted.get(n, ''))}, 'problem', {text(differences.get(n, ''))}, "
        f"'rows', count(1), 'wrong', {wrong(n)})"
        for n in [*wanted, *extra]
    ]
    found = df.selectExpr(f"array({', '.join(entries)}) as found").selectExpr("inline(found)")
    return found.selectExpr("column", "nullif(expected, '') as expected", "nullif(problem, '') as problem", "rows", "wrong")


def rows_with_many_nulls(df: DataFrame, maximum: int = 5) -> DataFrame:
    """Rows with more than ``maximum`` NULL columns, with their number."""
    nulls = reduce(lambda a, b: a + b, [F.col(quoted(c)).isNull().cast("int") for c in df.columns])
    return df.withColumn("null_columns", nulls).where(F.col("null_columns") > maximum)


def outliers(df: DataFrame, columns: Sequence[str] | None = None, sigmas: float = 3.0) -> DataFrame:
    """Rows outside mean +/- ``sigmas`` deviations, counted per numeric column.

    Two scans for all columns together. NaN is no measurement: it counts neither in the mean
    nor as an outlier. A column whose deviation is zero or unknown is left out.
    """
    columns = list(columns or [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)])
    rows = df.selectExpr(*[f"nanvl(cast({quoted(c)} as double), null) as v{i}" for i, c in enumerate(columns)])
    measured = ", ".join(f"avg(v{i}) as m{i}, stddev_samp(v{i}) as s{i}" for i in range(len(columns)))
    statistics = rows.selectExpr(f"struct({measured}) as st").scalar()
    counted = [
        f"named_struct('column', {text(c)}, 'mean', any_value(st.m{i}), 'stddev', any_value(st.s{i}), 'outliers', "
        f"count_if(v{i} > st.m{i} + st.s{i} * {float(sigmas)!r}d or v{i} < st.m{i} - st.s{i} * {float(sigmas)!r}d))"
        for i, c in enumerate(columns)
    ]
    found = rows.withColumn("st", statistics).selectExpr(f"array({', '.join(counted)}) as found")
    return found.selectExpr("inline(found)").where("stddev <> 0")


def health_score(report: DataFrame, minimum: float = MIN_HEALTH_SCORE) -> DataFrame:
    """Passed checks in percent of all checks that can fail, and whether that is enough."""
    per_check = report.where("is_valid is not null").groupBy("check", "column").agg(
        F.bool_and("is_valid").alias("passed")
    )
    totals = per_check.agg(F.count(F.lit(1)).alias("checks"), F.count_if("passed").alias("passed"))
    score = F.coalesce(F.round(F.try_divide(F.col("passed") * 100, F.col("checks")), 2), F.lit(0.0))
    return totals.select(
        "checks", "passed", score.alias("health_score"), (score >= minimum).alias("healthy")
    )


def quality_report(
    df: DataFrame,
    as_of: str | None = None,
    unique: Sequence[str] = ("id",),
    ranges: Mapping[str, Mapping[str, float]] | None = None,
    patterns: Mapping[str, str] | None = None,
) -> DataFrame:
    """Completeness, ranges, patterns, rules (one scan) and uniqueness (one narrow scan)."""
    checks = [completeness_check(c) for c in df.columns]
    checks += [range_check(c, r.get("min"), r.get("max")) for c, r in (ranges or {}).items()]
    checks += [pattern_check(c, p) for c, p in (patterns or {}).items()]
    checks += record_rules(df.columns, as_of)
    return run_checks(df, checks).unionByName(uniqueness(df, [c for c in unique if c in df.columns]))


def declared_checks(df: DataFrame, declared: Sequence[Mapping]) -> DataFrame:
    """Run checks declared as dictionaries with names null_check, range_check, duplicate_check."""
    counting, unique = [], []
    for spec in declared:
        columns = spec.get("columns") or [spec["column"]]
        if spec["name"] == "null_check":
            counting += [null_check(c) for c in columns]
        elif spec["name"] == "range_check":
            counting += [range_check(c, spec.get("min"), spec.get("max")) for c in columns]
        elif spec["name"] == "duplicate_check":
            unique += columns
        else:
            raise ValueError(f"unknown check {spec['name']!r}")
    report = run_checks(df, counting)
    return report.unionByName(uniqueness(df, unique)) if unique else report
