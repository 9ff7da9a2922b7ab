"""Top-N reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def direction(column: str, ascending: bool, nulls: str = "spark") -> Column:
    """Sort order of one column.

    ``nulls="spark"`` puts NULL first when ascending and last when descending;
    ``nulls="last"`` always puts it last.
    """
    if nulls not in ("spark", "last"):
        raise ValueError("nulls must be 'spark' or 'last'")
    if ascending:
        return F.asc_nulls_last(column) if nulls == "last" else F.asc_nulls_first(column)
    return F.desc_nulls_last(column)


def top_n(
    df: DataFrame,
    by: str,
    n: int = 10,
    ascending: bool = False,
    where: str | None = None,
    key: str = "id",
    nulls: str = "spark",
    columns: Sequence[str] | None = None,
    rank: str | None = None,
) -> DataFrame:
    """The ``n`` first rows by ``by``; ties are decided by ``key``.

    Each task keeps only its own ``n`` rows. The rank column is numbered on the ``n``
    remaining rows.
    """
    rows = df.where(where) if where else df
    if columns is not None:
        rows = rows.select(*dict.fromkeys([*columns, by, key]))
    order = [direction(by, ascending, nulls), F.asc(key)]
    first = rows.orderBy(*order).limit(n)
    if rank:
        first = first.withColumn(rank, F.row_number().over(Window.orderBy(*order)))
    if columns is not None:
        first = first.select(*([rank] if rank else []), *columns)
    return first


RANK_BASE = ("id", "title", "release_year")
RANK_METRICS = ("budget_musd", "revenue_musd", "vote_average", "vote_count")


def rank_report(
    df: DataFrame,
    column: str,
    ascending: bool = False,
    where: str | None = None,
    n: int = 10,
    key: str = "id",
    nulls: str = "spark",
) -> DataFrame:
    """Ranked records in the fixed report layout; the ranked column joins it if missing."""
    known = {*RANK_BASE, *RANK_METRICS}
    layout = [*RANK_BASE, *([] if column in known else [column]), *RANK_METRICS]
    return top_n(df, column, n, ascending, where, key, nulls, columns=layout, rank="rank")


def rank_all(df: DataFrame, specs: Sequence[Mapping], n: int = 10) -> dict[str, DataFrame]:
    """One report per spec (``name``, ``column``, optional ``ascending`` and ``filter``)."""
    return {
        spec["name"]: rank_report(
            df, spec["column"], spec.get("ascending", False), spec.get("filter"), spec.get("top_n", n)
        )
        for spec in specs
    }


def _entry(df: DataFrame, number: int, spec: Mapping) -> str | None:
    """SQL of a row's entry in one ranking, NULL where its filter fails; None for types that can't be turned round.

    Entries of all rankings are put in ascending order of the same fields: ``z`` for NULL, ``y`` for NaN, then the
    value in ``d`` or ``l``, turned round where the ranking descends.
    """
    column, up, kind = f"`{spec['column']}`", spec.get("ascending", False), df.schema[spec["column"]].dataType
    double, whole = "0d", "0L"
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        double = f"cast({column} as double)" if up else f"-cast({column} as double)"
    elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        whole = f"cast({column} as long)" if up else f"~cast({column} as long)"
    else:
        return None
    null, nan = f"{column} is null", f"coalesce(isnan(cast({column} as double)), false)"
    fields = (
        f"'m', {number}, 'z', {f'not {null}' if up else null}, 'y', {nan if up else f'not {nan}'}, 'd', coalesce({double}, 0d), 'l', coalesce({whole}, 0L), "
        f"'v', cast({column} as double)"
    )
    return f"case when {spec.get('filter') or 'true'} then named_struct({fields}) end"


def first_of_each(df: DataFrame, specs: Sequence[Mapping], n: int = 10, key: str = "id") -> DataFrame:
    """The first rows of all rankings from one scan: metric, rank, the key and the value ranked by.

    A row becomes one narrow entry per ranking. Each task cuts its entries to the first of every ranking before
    they are dealt out, so what shuffles is bounded by the number of tasks.
    """
    entries = {number: _entry(df, number, spec) for number, spec in enumerate(specs)}
    limits = [spec.get("top_n", n) for spec in specs]
    shared = [number for number, entry in entries.items() if entry]
    parts = []
    if shared:
        rows = df.select(F.col(key), F.explode(F.expr(f"array({', '.join(entries[i] for i in shared)})")).alias("__e")).where("__e is not null")
        order = Window.partitionBy("__e.m").orderBy("__e.z", "__e.y", "__e.d", "__e.l", key)
        ranked = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= max(limits[i] for i in shared))
        name = F.element_at(F.array(*[F.lit(spec["name"]) for spec in specs]), F.col("__e.m") + 1)
        limit = F.element_at(F.array(*[F.lit(k) for k in limits]), F.col("__e.m") + 1)
        parts.append(ranked.where(F.col("rank") <= limit).select(name.alias("metric"), "rank", key, F.col("__e.v").alias("value")))
    for number in set(entries) - set(shared):
        spec = specs[number]
        first = top_n(df, spec["column"], limits[number], spec.get("ascending", False), spec.get("filter"), key, columns=[key, spec["column"]], rank="rank")
        parts.append(first.select(F.lit(spec["name"]).alias("metric"), "rank", key, F.col(spec["column"]).try_cast("double").alias("value")))
    return reduce(DataFrame.unionByName, parts)


def rank_long(df: DataFrame, specs: Sequence[Mapping], n: int = 10, key: str = "id") -> DataFrame:
    """All reports in one table: metric, rank, id, title and the value ranked by.

    The rankings are found while the result is built, by one scan of their own columns; the few rows of them
    (at most ``n`` for each spec) are then fixed, and one more scan fetches their titles.
    """
    first = first_of_each(df, specs, n, key)
    found = df.sparkSession.createDataFrame(first.collect(), first.schema)
    wanted = found.select(F.col(key).alias("__wanted"))
    titles = df.select(key, "title").join(F.broadcast(wanted), F.col(key) == F.col("__wanted"), "left_semi")
    titles = titles.groupBy(F.col(key).alias("__key")).agg(F.min("title").alias("title"))
    joined = found.join(F.broadcast(titles), F.col(key).eqNullSafe(F.col("__key")), "left")
    return joined.select("metric", "rank", key, "title", "value")
