"""Cleaning steps for nested record tables, usable with ``df.transform``."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordwise.functions.dates import as_date
from recordwise.functions.nested import joined, names_in_json
from recordwise.operators.sizing import BROADCAST_BYTES, measured_bytes, settle

# Fixed values of the record model.
DROPPED = ("adult", "imdb_id", "original_title", "video", "homepage")
ARRAY_NAMES = {
    "genres": "name",
    "spoken_languages": "english_name",
    "production_countries": "name",
    "production_companies": "name",
}
ZERO_IS_MISSING = ("budget", "revenue", "runtime")
PLACEHOLDERS = ("No Data",)
PLACEHOLDER_COLUMNS = ("overview", "tagline")
KEPT_STATUS = "Released"


def drop_columns(df: DataFrame, names: Iterable[str] = DROPPED, extra: Iterable[str] = ()) -> DataFrame:
    """Drop columns; names that do not exist are ignored."""
    return df.drop(*names, *extra)


def struct_field(df: DataFrame, column: str, field: str = "name") -> DataFrame:
    """Replace a struct column by one of its fields; a NULL struct gives NULL."""
    return df.withColumn(column, F.col(column).getField(field))


def join_names(df: DataFrame, fields: Mapping[str, str | None]) -> DataFrame:
    """Replace array columns by ``|``-joined text; each maps to its struct field or None."""
    return df.withColumns({column: joined(column, field) for column, field in fields.items()})


def flatten_nested(
    df: DataFrame, collection: str = "belongs_to_collection", arrays: Mapping[str, str | None] = ARRAY_NAMES
) -> DataFrame:
    """Collection name and all array columns in a single projection."""
    texts = {column: joined(column, field) for column, field in arrays.items()}
    return df.withColumns({collection: F.col(collection).getField("name"), **texts})


def parse_json_names(df: DataFrame, column: str, field: str = "name") -> DataFrame:
    """Replace text that holds a JSON array of objects by their joined names."""
    return df.withColumn(column, names_in_json(column, field))


def zero_to_null(df: DataFrame, columns: Iterable[str] = ZERO_IS_MISSING) -> DataFrame:
    return df.withColumns({c: F.nullif(F.col(c), F.lit(0)) for c in columns})


def non_positive_to_null(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: F.when(F.col(c) > 0, F.col(c)) for c in columns})


def placeholder_to_null(
    df: DataFrame,
    columns: Iterable[str] = PLACEHOLDER_COLUMNS,
    placeholders: Sequence[str] = PLACEHOLDERS,
) -> DataFrame:
    return df.withColumns({c: F.when(~F.col(c).isin(*placeholders), F.col(c)) for c in columns})


def convert_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast text columns; values that do not fit become NULL instead of an error."""
    return df.withColumns(
        {c: as_date(c) if t == "date" else F.col(c).try_cast(t) for c, t in types.items()}
    )


def _comparable(df: DataFrame) -> list[Column]:
    """All columns in an order that depends on nothing but their values; maps count by their sorted entries."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        columns.append(F.array_sort(F.map_entries(column)) if isinstance(field.dataType, T.MapType) else column)
    return columns


def one_per_key(
    df: DataFrame,
    key: str | Sequence[str] = "id",
    order_by: str | None = None,
    keep: str = "first",
    settle_repeated: bool = False,
) -> DataFrame:
    """One row per key (one or several columns), the same one however the rows are laid out.

    Without ``order_by`` the row with the smallest values stays, compared column by column in
    the frame's order, NULL first. With it, the row with the smallest (``keep="first"``) or
    largest (``keep="last"``) value stays, equal ones decided as above; rows with a NULL order
    value stay only if their key has no other. Rows are combined before the shuffle, so a
    key with very many copies reaches its final task as a few rows.

    For tables in which few keys repeat, ``settle_repeated`` counts the keys first, while the frame is built: rows
    whose key stands once then stay where they are and only the others are combined, unless the repeated keys are
    too many to broadcast. Give it a table that was read back, because it is read three times.
    """
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    keys = [key] if isinstance(key, str) else list(key)
    if settle_repeated:
        named = [f"__key{i}" for i in range(len(keys))]
        counted = df.groupBy(*[F.col(f"`{k}`").alias(n) for k, n in zip(keys, named)]).agg(F.count(F.lit(1)).alias("__n"))
        repeated = settle(counted.where("__n > 1").select(*named))
        if measured_bytes(repeated) <= BROADCAST_BYTES:
            same = reduce(and_, [F.col(f"`{k}`").eqNullSafe(F.col(n)) for k, n in zip(keys, named)])
            combined = one_per_key(df.join(F.broadcast(repeated), same, "left_semi"), keys, order_by, keep)
            return df.join(F.broadcast(repeated), same, "left_anti").unionByName(combined)
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    order = _comparable(df)
    if order_by is None and not any(isinstance(f.dataType, T.MapType) for f in df.schema.fields):
        chosen = F.min(row)  # the row is its own order: nothing is sorted and shuffled twice
    elif order_by is None:
        chosen = F.min_by(row, F.struct(*order))
    elif keep == "first":
        chosen = F.min_by(row, F.struct(F.col(order_by).isNull(), F.col(order_by), *order))
    else:
        chosen = F.max_by(row, F.struct(F.col(order_by).isNotNull(), F.col(order_by), *order))
    return df.groupBy(*keys).agg(chosen.alias("__row")).select("__row.*")


def require_columns(df: DataFrame, columns: Sequence[str] = ("id", "title")) -> DataFrame:
    """Drop rows in which one of ``columns`` is NULL."""
    return df.dropna(subset=list(columns))


def require_values(df: DataFrame, minimum: int = 10) -> DataFrame:
    """Keep rows with at least ``minimum`` values that are not NULL."""
    return df.dropna(thresh=minimum)


def keep_status(df: DataFrame, value: str = KEPT_STATUS, column: str = "status") -> DataFrame:
    return df.where(F.col(column) == value).drop(column)


def repair_records(
    df: DataFrame,
    key: str = "id",
    title: str = "title",
    zero_columns: Iterable[str] = ZERO_IS_MISSING,
    placeholder_columns: Iterable[str] = PLACEHOLDER_COLUMNS,
    placeholders: Sequence[str] = PLACEHOLDERS,
    min_values: int | None = None,
    settle_repeated: bool = False,
) -> DataFrame:
    """Missing-value repair, deduplication and row filters in one chain.

    Rows without a key are removed before deduplication, which changes no result and keeps
    them out of the shuffle. The status filter must follow deduplication: which copy of a
    record is kept decides whether the record passes. ``min_values`` asks for that many values that
    are not NULL, ``settle_repeated`` is that of ``one_per_key``.
    """
    repaired = (
        df.transform(zero_to_null, zero_columns)
        .transform(placeholder_to_null, placeholder_columns, placeholders)
        .dropna(subset=[key])
        .transform(one_per_key, key, settle_repeated=settle_repeated)
        .transform(require_columns, (key, title))
        .transform(keep_status)
    )
    return repaired if min_values is None else require_values(repaired, min_values)


def clean(df: DataFrame, extra_drops: Iterable[str] = (), **repairs) -> DataFrame:
    """Raw nested records to the flat cleaned table; ``repairs`` goes to ``repair_records``."""
    return (
        df.transform(drop_columns, DROPPED, extra_drops)
        .transform(flatten_nested)
        .transform(repair_records, **repairs)
    )


def order_columns(df: DataFrame, order: Sequence[str], keep_others: bool = True) -> DataFrame:
    """Columns in ``order`` as far as they exist, then (optionally) all others."""
    listed = [c for c in order if c in df.columns]
    others = [c for c in df.columns if c not in listed] if keep_others else []
    return df.select(*listed, *others)


def with_row_index(df: DataFrame, name: str = "index") -> DataFrame:
    """Unique, increasing, not consecutive row numbers."""
    return df.withColumn(name, F.monotonically_increasing_id())
