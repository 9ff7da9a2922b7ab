"""Chart datasets: each returns the few rows a chart needs, not the rows behind it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordwise.operators.grouping import group_metrics, sort_columns


def histogram(
    df: DataFrame, value: str, bins: int, where: str | None = None, within: tuple[float, float] | None = None
) -> DataFrame:
    """Counts in ``bins`` equal steps between the smallest and largest value.

    ``value`` is a SQL expression. ``within`` first restricts the values to a closed
    interval. Every bin is returned, empty ones with 0; a bin includes its lower edge and
    the last bin also its upper edge. When all values are equal the steps cover half a unit
    on either side. NaN has no place on the axis and is left out, like NULL; ``unplaced`` counts
    both. No values at all give no rows.
    """
    known = "v is not null and not isnan(v)" if within is None else f"v between {within[0]} and {within[1]} and not isnan(v)"
    rows = (df.where(where) if where else df).selectExpr(f"cast({value} as double) as v").where(known)
    span = rows.selectExpr(
        "case when count(v) > 0 then named_struct("
        "'low', if(min(v) = max(v), min(v) - 0.5d, min(v)), 'high', if(min(v) = max(v), max(v) + 0.5d, max(v))) end as span"
    )

    def edge(index: str) -> str:
        return f"if({index} = {bins}, span.high, span.low + ({index}) * ((span.high - span.low) / {bins}))"

    placed = (
        rows.withColumn("span", span.scalar())
        .selectExpr("v", "span", f"least({bins - 1}, floor((v - span.low) / (span.high - span.low) * {bins})) as guess")
        # rounding in the division can miss by one step; the edges decide
        .selectExpr(
            f"guess + case when v < {edge('guess')} then -1 "
            f"when v >= {edge('guess + 1')} and guess < {bins - 1} then 1 else 0 end as bin"
        )
    )
    counts = placed.groupBy("bin").agg(F.expr("count(1) as n"))
    # at most `bins` rows on either side
    frame = df.sparkSession.range(bins).withColumnRenamed("id", "bin").withColumn("span", span.scalar())
    return (
        frame.where("span is not null")
        .join(F.broadcast(counts), "bin", "left")
        .selectExpr(
            "cast(bin as int) as bin",
            f"{edge('bin')} as bin_start",
            f"{edge('bin + 1')} as bin_end",
            "coalesce(n, 0) as count",
        )
        .orderBy("bin")
    )


def grid_counts(df: DataFrame, x: str, y: str, bins: int, where: str | None = None) -> DataFrame:
    """Rows per cell of a grid of ``bins`` by ``bins`` equal steps over the spans of two SQL expressions.

    Rows where one of them is NULL or NaN are left out; only cells with rows are returned.
    """
    rows = (df.where(where) if where else df).selectExpr(f"cast({x} as double) as x", f"cast({y} as double) as y")
    rows = rows.where("x is not null and y is not null and not isnan(x) and not isnan(y)")
    span = rows.selectExpr("named_struct('x0', min(x), 'x1', max(x), 'y0', min(y), 'y1', max(y)) as span").scalar()

    def step(v: str) -> str:
        return f"cast(coalesce(least({bins - 1}, floor(try_divide({v} - span.{v}0, span.{v}1 - span.{v}0) * {bins})), 0) as int)"

    placed = rows.withColumn("span", span).selectExpr(f"{step('x')} as x_bin", f"{step('y')} as y_bin")
    return placed.groupBy("x_bin", "y_bin").agg(F.count(F.lit(1)).alias("count"))


def unplaced(df: DataFrame, value: str, where: str | None = None) -> DataFrame:
    """One row: the rows of a histogram's frame, and those of them with NULL and with NaN."""
    rows = (df.where(where) if where else df).selectExpr(f"cast({value} as double) as v")
    return rows.selectExpr("count(1) as rows", "count_if(v is null) as nulls", "count_if(isnan(v)) as nans")


BOX_QUANTILES = {"low": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "high": 1.0}


def box_stats(df: DataFrame, keys: Sequence[str], value: str, order_by: Sequence[str] = ()) -> DataFrame:
    """Count, mean, deviation and exact quartiles of ``value`` (SQL) per group."""
    rows = df.select(*keys, F.expr(value).cast("double").alias("v")).where(F.col("v").isNotNull())
    inner = {n: ("v", p) for n, p in BOX_QUANTILES.items() if 0 < p < 1}
    measures = {"count": "count(v)", "mean": "avg(v)", "stddev": "stddev_samp(v)", "low": "min(v)", "high": "max(v)"}
    layout = [*keys, "count", "mean", "stddev", *BOX_QUANTILES]
    return group_metrics(rows, keys, measures, quantiles=inner, columns=layout, order_by=order_by)


def top_groups(df: DataFrame, key: str, measure: str, n: int, where: str | None = None) -> DataFrame:
    """The ``n`` groups with the largest ``measure`` (SQL aggregate); ties go by key."""
    rows = df.where(where) if where else df
    ranked = rows.groupBy(key).agg(F.expr(measure).alias("__by"))
    return ranked.orderBy(F.desc("__by"), F.asc(key)).limit(n).select(key)


def only_groups(df: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key is among ``groups``, a top-n result and so of fixed size."""
    return df.join(F.broadcast(groups), key, "left_semi")


def share_of_total(counted: DataFrame, column: str = "count", name: str = "percent") -> DataFrame:
    total = counted.agg(F.sum(column)).scalar()
    return counted.withColumn(name, F.try_divide(F.col(column) * 100.0, total))


def min_max_scaled(df: DataFrame, columns: Sequence[str], suffix: str = "_scaled") -> DataFrame:
    """Each column scaled to 0..1 over all rows; a constant column gives NULL."""
    limits = df.selectExpr(
        f"struct({', '.join(f'min({c}) as low_{c}, max({c}) as high_{c}' for c in columns)}) as limits"
    ).scalar()
    scaled = [
        f"try_divide({c} - limits.low_{c}, limits.high_{c} - limits.low_{c}) as {c}{suffix}" for c in columns
    ]
    return df.withColumn("limits", limits).selectExpr("*", *scaled).drop("limits")


def matrix(df: DataFrame, row: str, column: str, value: str, columns: Sequence, prefix: str = "") -> DataFrame:
    """One row per ``row``, one column per entry of ``columns``, holding a SQL aggregate.

    The column values are given, so no job runs to find them.
    """
    names = {f"{prefix}{c}": c for c in columns}
    cells = df.groupBy(row).pivot(column, list(columns)).agg(F.expr(value))
    return cells.select(row, *[F.col(f"`{c}`").alias(name) for name, c in names.items()]).orderBy(row)


def repeatable_sample(df: DataFrame, n: int, key: str = "id") -> DataFrame:
    """``n`` rows chosen by a hash of the key: the same rows however the data is laid out.

    Whole-number keys are spread by a multiplication (so any SQL engine can repeat it),
    other keys by ``xxhash64``.
    """
    if isinstance(df.schema[key].dataType, (T.IntegerType, T.LongType)):
        spread = F.pmod(F.pmod(F.col(key), F.lit(2**31)) * F.lit(2654435761), F.lit(2**32))
    else:
        spread = F.xxhash64(key)
    return df.orderBy(spread, F.asc(key)).limit(n)


def band_around_mean(
    df: DataFrame, key: str, value: str, name: str = "value", order_by: Sequence[str] = ()
) -> DataFrame:
    """Mean, deviation and mean -/+ one deviation per group."""
    return group_metrics(
        df,
        [key],
        {f"avg_{name}": f"avg({value})", f"std_{name}": f"stddev_samp({value})"},
        derived={"lower": f"avg_{name} - std_{name}", "upper": f"avg_{name} + std_{name}"},
        order_by=order_by or [key],
    )


def correlations(
    df: DataFrame,
    pairs: Mapping[str, tuple[str, str]],
    where: str | None = None,
    null_policy: str = "pairwise",
) -> DataFrame:
    """Pearson correlation of every pair from one aggregation: rows (pair, correlation).

    ``null_policy="pairwise"`` uses the rows where both values are known, ``"zero"`` reads
    NULL as 0.
    """
    if null_policy not in ("pairwise", "zero"):
        raise ValueError("null_policy must be 'pairwise' or 'zero'")

    def side(column: str) -> Column:
        value = F.col(column).cast("double")
        return F.coalesce(value, F.lit(0.0)) if null_policy == "zero" else value

    rows = df.where(where) if where else df
    one_row = rows.agg(*[F.corr(side(a), side(b)).alias(name) for name, (a, b) in pairs.items()])
    return one_row.unpivot([], list(pairs), "pair", "correlation")


def stacked(named: Mapping[str, DataFrame], label: str) -> DataFrame:
    """Frames of the same layout in one, with their name in column ``label``."""
    parts = [frame.select(F.lit(name).alias(label), "*") for name, frame in named.items()]
    return reduce(DataFrame.unionByName, parts)


def ordered(df: DataFrame, *order_by: str) -> DataFrame:
    return df.orderBy(*sort_columns(order_by))
