"""Expressions over structs, arrays and delimited multi-value text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordwise.functions.values import ColumnOrName, as_column

SEPARATOR = "|"


def joined(values: ColumnOrName, field: str | None = None, separator: str = SEPARATOR) -> Column:
    """Join an array (or one field of an array of structs) into text.

    An empty or NULL array gives NULL; NULL elements are skipped, so an array holding
    only NULL names gives an empty string.
    """
    values = as_column(values)
    parts = values if field is None else values.getField(field)
    return F.when(F.size(values) > 0, F.concat_ws(separator, parts))


def tokens(text: ColumnOrName, separator: str = SEPARATOR) -> Column:
    """Array of the parts of delimited text; NULL text gives NULL."""
    return F.split(as_column(text), f"\\Q{separator}\\E")


def first_token(text: ColumnOrName, separator: str = SEPARATOR) -> Column:
    return F.get(tokens(text, separator), 0)


def names_in_json(text: ColumnOrName, field: str = "name") -> Column:
    """Joined names from text holding a JSON array of objects."""
    parsed = F.from_json(as_column(text), T.ArrayType(T.StructType([T.StructField(field, T.StringType())])))
    return joined(parsed, field)


def leaf_columns(schema: T.StructType, separator: str = "_") -> list[Column]:
    """One column per non-struct field, named by its path joined with ``separator``."""

    def walk(struct: T.StructType, path: tuple[str, ...]):
        for field in struct.fields:
            here = (*path, field.name)
            if isinstance(field.dataType, T.StructType):
                yield from walk(field.dataType, here)
            else:
                quoted = ".".join(f"`{part}`" for part in here)
                yield F.col(quoted).alias(separator.join(here))

    return list(walk(schema, ()))
