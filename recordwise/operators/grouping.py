"""Grouped metrics: the one operator behind all KPI and metric tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordwise.functions.nested import SEPARATOR, tokens
from recordwise.operators.quantiles import grouped_with_quantiles
from recordwise.operators.sizing import settle


def explode_values(
    df: DataFrame,
    column: str,
    alias: str,
    separator: str = SEPARATOR,
    keep_null: bool = False,
    drop_empty: bool = False,
) -> DataFrame:
    """One row per value of a multi-value column (delimited text or array).

    A NULL column gives no row unless ``keep_null``; empty text gives one empty value
    unless ``drop_empty``.
    """
    is_array = isinstance(df.schema[column].dataType, T.ArrayType)
    values = F.col(column) if is_array else tokens(column, separator)
    exploded = df.withColumn(alias, (F.explode_outer if keep_null else F.explode)(values))
    if drop_empty:
        exploded = exploded.where(F.col(alias).isNull() | (F.col(alias) != ""))
    return exploded


def sort_columns(order_by: Sequence[str]) -> list[Column]:
    """``"name"`` sorts upwards, ``"-name"`` downwards; NULL follows Spark's default."""
    return [F.desc(name[1:]) if name.startswith("-") else F.asc(name) for name in order_by]


def group_metrics(
    df: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, str],
    quantiles: Mapping[str, tuple[str, float]] | None = None,
    where: str | None = None,
    having: str | None = None,
    derived: Mapping[str, str] | None = None,
    order_by: Sequence[str] = (),
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Filter, group, aggregate, derive, filter groups and sort.

    ``measures`` and ``derived`` map output names to SQL expressions, ``quantiles`` to
    ``(expression, probability)``. All aggregates are combined before the shuffle, so a
    frequent key costs no more than a rare one.
    """
    rows = df.where(where) if where else df
    if quantiles:
        result = grouped_with_quantiles(rows, keys, measures, quantiles)
    else:
        result = rows.groupBy(*keys).agg(*[F.expr(f"{sql} as `{name}`") for name, sql in measures.items()])
    return _finished(result, having, derived, order_by, columns)


def _finished(
    result: DataFrame,
    having: str | None = None,
    derived: Mapping[str, str] | None = None,
    order_by: Sequence[str] = (),
    columns: Sequence[str] | None = None,
) -> DataFrame:
    if derived:
        result = result.selectExpr("*", *[f"{sql} as `{name}`" for name, sql in derived.items()])
    if having:
        result = result.where(having)
    if columns:
        result = result.select(*columns)
    return result.orderBy(*sort_columns(order_by)) if order_by else result


@dataclass(frozen=True)
class Report:
    """A grouped table that can be computed alone or together with others; fields as in ``group_metrics``."""

    keys: Sequence[str]
    measures: Mapping[str, str]
    where: str | None = None
    having: str | None = None
    derived: Mapping[str, str] | None = None
    order_by: Sequence[str] = ()

    def of(self, df: DataFrame) -> DataFrame:
        return group_metrics(df, self.keys, self.measures, None, self.where, self.having, self.derived, self.order_by)


def reports_together(df: DataFrame, reports: Mapping[str, Report]) -> dict[str, DataFrame]:
    """All ``reports`` of one table from one scan and one shuffle.

    Each report is a grouping set. A row is expanded once per set and combined with others of its group before the
    shuffle; every distinct aggregate is computed once per set. A report's filter is a grouping column of its set,
    so rows that fail it form a group that is left out. The groups of all reports are settled while the reports
    are built: they are what the reports hold, and each report reads its own from there.
    """
    names = {sql: f"__m{i}" for i, sql in enumerate(dict.fromkeys(sql for r in reports.values() for sql in r.measures.values()))}
    filters = {where: f"__w{i}" for i, where in enumerate(dict.fromkeys(r.where for r in reports.values() if r.where))}
    flagged = df.withColumns({name: F.coalesce(F.expr(where), F.lit(False)) for where, name in filters.items()})
    sets = {name: [*r.keys, *([filters[r.where]] if r.where else [])] for name, r in reports.items()}
    columns = list(dict.fromkeys(c for group in sets.values() for c in group))
    distinct_sets = list(dict.fromkeys(tuple(group) for group in sets.values()))
    aggregates = [F.expr(f"{sql} as {name}") for sql, name in names.items()]
    # a measure may read a grouping column, which a grouping set would turn into NULL, so the keys are copies
    copies = {c: f"__k{i}" for i, c in enumerate(columns)}
    rows = flagged.withColumns({copy: F.col(f"`{c}`") for c, copy in copies.items()})
    grouped = rows.groupingSets([[F.col(copies[c]) for c in group] for group in distinct_sets], *copies.values())
    groups = settle(grouped.agg(F.grouping_id().alias("__set"), *aggregates))

    def one(name: str, report: Report) -> DataFrame:
        number = sum(1 << place for place, c in enumerate(reversed(columns)) if c not in sets[name])  # a bit per column outside the set
        own = groups.where(F.col("__set") == number)
        if report.where:
            own = own.where(F.col(copies[filters[report.where]]))
        shown = [F.col(copies[k]).alias(k) for k in report.keys] + [F.col(names[sql]).alias(m) for m, sql in report.measures.items()]
        return _finished(own.select(*shown), report.having, report.derived, report.order_by)

    return {name: one(name, report) for name, report in reports.items()}


AGGREGATES = {
    "count": "count({c})",
    "sum": "sum({c})",
    "mean": "avg({c})",
    "std": "stddev_samp({c})",
    "min": "min({c})",
    "max": "max({c})",
}


def agg_matrix(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], aggregations: Sequence[str]
) -> DataFrame:
    """Every aggregation over every column, in columns named ``<column>_<aggregation>``."""
    measures = {
        f"{c}_{a}": AGGREGATES[a].format(c=f"`{c}`") for c in columns for a in aggregations if a != "median"
    }
    quantiles = {f"{c}_median": (f"`{c}`", 0.5) for c in columns} if "median" in aggregations else None
    names = [f"{c}_{a}" for c in columns for a in aggregations]
    return group_metrics(df, keys, measures, quantiles=quantiles, columns=[*keys, *names])
