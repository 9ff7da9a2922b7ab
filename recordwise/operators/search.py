"""Filters that work as searches over records."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordwise.functions.nested import SEPARATOR, tokens
from recordwise.operators.ranking import direction, top_n


def has_value(df: DataFrame, column: str, value: str, match: str = "exact", separator: str = SEPARATOR) -> Column:
    """Whether a multi-value column holds ``value``.

    ``match="exact"`` compares whole values, ``match="substring"`` looks anywhere in the
    text (for an array: in any element). Works on delimited text and on arrays. On text, the
    cheap substring test comes first: it reaches the Parquet scan and spares most splits.
    """
    if match not in ("exact", "substring"):
        raise ValueError("match must be 'exact' or 'substring'")
    is_array = isinstance(df.schema[column].dataType, T.ArrayType)
    if is_array:
        if match == "exact":
            return F.array_contains(F.col(column), value)
        return F.exists(column, lambda element: element.contains(value))
    within = F.col(column).contains(value)
    return within if match == "substring" else within & F.array_contains(tokens(column, separator), value)


def find(
    df: DataFrame,
    contains: Sequence[tuple[str, str]] = (),
    equals: Sequence[tuple[str, object]] = (),
    sort_by: str | None = None,
    ascending: bool = True,
    match: str = "exact",
    key: str = "id",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Rows that hold every ``(column, value)`` of ``contains`` and of ``equals``.

    A global sort first samples its input. The found rows are therefore rebalanced before,
    so that sampling and sorting read those few rows, and the table is scanned only once.
    """
    conditions = [has_value(df, column, value, match) for column, value in contains]
    conditions += [F.col(column) == F.lit(value) for column, value in equals]
    rows = df.where(reduce(and_, conditions)) if conditions else df
    if columns is not None:
        rows = rows.select(*columns)
    if sort_by is None:
        return rows
    return rows.hint("rebalance").orderBy(direction(sort_by, ascending), F.asc(key))


def in_range(df: DataFrame, column: str, low, high) -> DataFrame:
    """Rows with ``column`` between both bounds, bounds included."""
    return df.where(F.col(column).between(low, high))


def top_in_value(
    df: DataFrame,
    column: str,
    value: str,
    by: str,
    n: int = 10,
    where: str | None = None,
    match: str = "exact",
    key: str = "id",
) -> DataFrame:
    """Top rows by ``by`` among those whose multi-value column holds ``value``."""
    rows = df.where(has_value(df, column, value, match) & F.col(by).isNotNull())
    return top_n(rows, by, n, where=where, key=key)
