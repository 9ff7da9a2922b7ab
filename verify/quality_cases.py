"""Data quality reports (inventory group D)."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordwise.operators import quality
from verify.base import case, raw, records, rounded, sql, table

AS_OF = "2000-06-30"
RANGES = {"budget_musd": {"min": 0, "max": 100}, "revenue_musd": {"min": 1, "max": 200}, "vote_average": {"min": 0, "max": 8}}
PATTERNS = {"release_date": r"^\d{4}-0[1-6]-\d{2}$", "title": "^Order#[0-9]+$"}
DECLARED = (
    {"name": "null_check", "columns": ["id", "title", "revenue_musd"]},
    {"name": "range_check", "column": "vote_average", "min": 0, "max": 10},
    {"name": "duplicate_check", "columns": ["id", "director"]},
)
LINE_NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber")


def entry(check, column, metric, value, source, valid="cast(null as boolean)"):
    return (
        f"select '{check}' as \"check\", '{column}' as \"column\", '{metric}' as metric, "
        f"cast({value} as double) as value, {valid} as is_valid from {source}"
    )


def stack(*parts):
    return " union all ".join(part for group in parts for part in ([group] if isinstance(group, str) else group))


def completeness_sql(columns, source):
    rows = []
    for c in columns:
        q = f'"{c}"'
        rows += [
            entry("completeness", c, "total_rows", "count(*)", source),
            entry("completeness", c, "null_count", f"count(*) - count({q})", source),
            entry("completeness", c, "non_null_count", f"count({q})", source),
            entry("completeness", c, "completeness_percentage",
                  f"coalesce(round(count({q}) * 100 / nullif(count(*), 0), 2), 0)", source),
        ]
    return rows


def uniqueness_sql(columns, source):
    rows = []
    for c in columns:
        distinct = f"(count(distinct {c}) + cast(count(*) > count({c}) as int))"
        valid = f"count(*) = {distinct}"
        rows += [
            entry("uniqueness", c, "total_count", "count(*)", source, valid),
            entry("uniqueness", c, "distinct_count", distinct, source, valid),
            entry("uniqueness", c, "duplicate_count", f"count(*) - {distinct}", source, valid),
        ]
    return rows


def range_sql(c, low, high, source):
    below, above = f"count(*) filter (where {c} < {low})", f"count(*) filter (where {c} > {high})"
    valid = f"{below} = 0 and {above} = 0"
    return [
        entry("range", c, "min_value", f"round(min({c}), 6)", source, valid),
        entry("range", c, "max_value", f"round(max({c}), 6)", source, valid),
        entry("range", c, "violations_below_min", below, source, valid),
        entry("range", c, "violations_above_max", above, source, valid),
    ]


def pattern_sql(c, pattern, source):
    match = f"count(*) filter (where regexp_matches({c}, '{pattern}'))"
    return [
        entry("pattern", c, "total_non_null", f"count({c})", source),
        entry("pattern", c, "matching_pattern", match, source),
        entry("pattern", c, "not_matching", f"count({c}) - {match}", source),
        entry("pattern", c, "match_percentage", f"coalesce(round({match} * 100 / nullif(count({c}), 0), 2), 0)", source),
    ]


RULES = {
    "revenue_vs_budget": "revenue_musd > 0 and budget_musd > 0 and revenue_musd < budget_musd",
    "vote_average_range": "vote_average < 0 or vote_average > 10",
    "future_release_dates": f"try_cast(release_date as date) > date '{AS_OF}'",
}


def rule_sql(name, source):
    count = f"count(*) filter (where {RULES[name]})"
    return entry("rule", name, "violations", count, source, f"{count} = 0")


def reference_sql(column, source, valid_values):
    bad = f"count(*) filter (where {column} is not null and {column} not in ({valid_values}))"
    valid = f"{bad} = 0"
    return stack(
        entry("reference", column, "total_rows", "count(*)", source, valid),
        entry("reference", column, "invalid_references", bad, source, valid),
        entry("reference", column, "null_references", f"count(*) - count({column})", source, valid),
        entry("reference", column, "valid_percentage", f"round((count(*) - {bad}) * 100 / count(*), 2)", source, valid),
    )


def outlier_sql(columns, source):
    parts = []
    for c in columns:
        parts.append(
            f"select '{c}' as \"column\", round(m, 6) as mean, round(s, 6) as stddev, "
            f"(select count(*) from {source} where {c} > m + 3 * s or {c} < m - 3 * s) as outliers "
            f"from (select avg({c}) as m, stddev_samp({c}) as s from {source})"
        )
    return f"select * from ({' union all '.join(parts)}) where stddev <> 0"


REPORT_COLUMNS = (
    "id", "title", "release_date", "budget_musd", "revenue_musd", "vote_average", "runtime", "director", "tagline",
)


def report(spark, folder):
    return quality.quality_report(records(spark, folder).select(*REPORT_COLUMNS), AS_OF, ranges=RANGES, patterns=PATTERNS)


REPORT_SQL = stack(
    completeness_sql(REPORT_COLUMNS, "records"),
    [part for c, r in RANGES.items() for part in range_sql(c, r["min"], r["max"], "records")],
    [part for c, p in PATTERNS.items() for part in pattern_sql(c, p, "records")],
    [rule_sql(name, "records") for name in RULES],
    uniqueness_sql(["id"], "records"),
)
DECLARED_SQL = stack(
    [entry("null", c, "null_count", f"count(*) - count({c})", "records", f"count(*) = count({c})")
     for c in ("id", "title", "revenue_musd")],
    range_sql("vote_average", 0, 10, "records"),
    uniqueness_sql(["id", "director"], "records"),
)


def checks(source, *wanted):
    return lambda s, d: rounded(quality.run_checks(source(s, d), wanted))


def given(name):
    return lambda s, d: table(s, d, name)


def schema_problems(spark, folder):
    """Order facts as text, one column missing, one extra: which rows convert to the expected types."""
    from pyspark.sql import types as T

    found = table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("o_custkey"), F.col("o_totalprice").cast("string").alias("o_totalprice"), "o_orderstatus"
    )
    expected = T.StructType.fromDDL("o_orderkey bigint, o_custkey bigint, o_totalprice double, o_clerk string")
    return quality.schema_check(found, expected)


CASES = [
    case("d01_schema_check", schema_problems,
         "select * from (select count(*) as rows from orders), (values ('o_orderkey', 'bigint', null, 0), ('o_custkey', 'bigint', 'type', 1), "
         "('o_totalprice', 'double', 'type', 0), ('o_clerk', 'string', 'missing', 1), ('o_orderstatus', null, 'extra', 0)) "
         "v(\"column\", expected, problem, part)".replace("select * from", "select rows, \"column\", expected, problem, cast(part * rows as bigint) as wrong from")),
    case("d02_completeness", lambda s, d: quality.completeness(records(s, d).select(*REPORT_COLUMNS)),
         sql.records(stack(completeness_sql(REPORT_COLUMNS, "records")))),
    case("d02_completeness_lines", lambda s, d: quality.completeness(table(s, d, "lineitem")),
         stack(completeness_sql(
             "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag "
             "l_linestatus l_shipdate".split(), "lineitem"))),
    case("d03_uniqueness", lambda s, d: quality.uniqueness(records(s, d), ["id", "director"]),
         sql.records(stack(uniqueness_sql(["id", "director"], "records")))),
    case("d03_uniqueness_lines", lambda s, d: quality.uniqueness(table(s, d, "lineitem"), ["l_orderkey", "l_returnflag"]),
         stack(uniqueness_sql(["l_orderkey", "l_returnflag"], "lineitem"))),
    case("d04_ranges", checks(records, *[quality.range_check(c, r["min"], r["max"]) for c, r in RANGES.items()]),
         sql.records(stack([p for c, r in RANGES.items() for p in range_sql(c, r["min"], r["max"], "records")]))),
    case("d04_ranges_lines",
         checks(given("lineitem"), quality.range_check("l_quantity", 2, 49), quality.range_check("l_discount", 0, 0.05)),
         stack(range_sql("l_quantity", 2, 49, "lineitem"), range_sql("l_discount", 0, 0.05, "lineitem"))),
    case("d05_patterns", checks(records, *[quality.pattern_check(c, p) for c, p in PATTERNS.items()]),
         sql.records(stack([p for c, x in PATTERNS.items() for p in pattern_sql(c, x, "records")]))),
    case("d05_patterns_documents", checks(given("documents"), quality.pattern_check("text", "[A-Z][a-z]+ing")),
         stack(pattern_sql("text", "[A-Z][a-z]+ing", "documents"))),
    case("d06_references", lambda s, d: quality.references(table(s, d, "orders"), "o_orderkey", table(s, d, "lineitem"), "l_orderkey"),
         reference_sql("o_orderkey", "orders", "select l_orderkey from lineitem")),
    case("d06_references_list",
         lambda s, d: quality.references_in_list(raw(s, d), "director", ["Supplier#000000001", "Supplier#000000002"]),
         sql.raw(reference_sql("director", "raw", "'Supplier#000000001', 'Supplier#000000002'"))),
    case("d06_references_labels", lambda s, d: quality.references(table(s, d, "labels"), "doc_id", table(s, d, "documents"), "doc_id"),
         reference_sql("doc_id", "labels", "select doc_id from documents")),
    *[
        case(f"d0{7 + i}_rule_{name}",
             lambda s, d, i=i: quality.run_checks(
                 records(s, d), [quality.record_rules(["revenue_musd", "budget_musd", "vote_average", "release_date"], AS_OF)[i]]),
             sql.records(rule_sql(name, "records")))
        for i, name in enumerate(RULES)
    ],
    case("d10_quality_report", lambda s, d: rounded(report(s, d)), sql.records(REPORT_SQL)),
    case("d11_health_score", lambda s, d: quality.health_score(report(s, d)),
         sql.records(
             f"select *, health_score >= 80 as healthy from (select count(*) as checks, cast(sum(ok) as bigint) as passed, "
             f"round(sum(ok) * 100 / count(*), 2) as health_score from (select \"check\", \"column\", "
             f"cast(bool_and(is_valid) as int) as ok from ({REPORT_SQL}) where is_valid is not null group by 1, 2))")),
    case("d12_null_counts", lambda s, d: quality.null_counts(records(s, d).select(*REPORT_COLUMNS)),
         sql.records(" union all ".join(
             f"select '{c}' as \"column\", count(*) - count({c}) as null_count from records" for c in REPORT_COLUMNS))),
    case("d13_rows_with_many_nulls",
         lambda s, d: rounded(quality.rows_with_many_nulls(
             records(s, d).select("id", "budget_musd", "roi", "runtime", "director", "tagline", "genres"), 2)),
         sql.records("select id, round(budget_musd, 6) as budget_musd, round(roi, 6) as roi, runtime, director, tagline, genres, "
                     "null_columns from (select *, " + " + ".join(
                         f"cast({c} is null as int)" for c in ("budget_musd", "roi", "runtime", "director", "tagline", "genres"))
                     + " as null_columns from records) where null_columns > 2")),
    case("d14_outliers_lines",
         lambda s, d: rounded(quality.outliers(table(s, d, "lineitem"), LINE_NUMBERS)), outlier_sql(LINE_NUMBERS, "lineitem")),
    case("d14_outliers",
         lambda s, d: rounded(quality.outliers(records(s, d).select("roi", "budget_musd", "vote_count", "popularity", "runtime"))),
         sql.records(outlier_sql(("roi", "budget_musd", "vote_count", "popularity", "runtime"), "records"))),
    case("d15_declared_checks", lambda s, d: rounded(quality.declared_checks(records(s, d), DECLARED)), sql.records(DECLARED_SQL)),
]
