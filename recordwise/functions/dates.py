"""Date expressions over text, date or timestamp columns; bad text gives NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordwise.functions.values import ColumnOrName, as_column


def as_date(value: ColumnOrName, pattern: str | None = None) -> Column:
    """Date of a column, tolerant of bad text also under ANSI mode."""
    value = as_column(value)
    return F.try_to_date(value, pattern) if pattern else value.try_cast("date")


def year_of(value: ColumnOrName) -> Column:
    return F.year(as_date(value))


def month_of(value: ColumnOrName) -> Column:
    return F.month(as_date(value))


def quarter_of(value: ColumnOrName) -> Column:
    return F.quarter(as_date(value))


def decade_of(year: ColumnOrName) -> Column:
    return (F.floor(as_column(year) / 10) * 10).cast("int")
