"""Key handling shared by the operators that join a frame back to its own groups."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_on_groups(rows: DataFrame, groups: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join where a NULL key matches a NULL key, as it does in ``groupBy``.

    The key columns of ``groups`` are dropped, so each key appears once. ``groups`` may
    carry a broadcast mark.
    """
    renamed = {key: f"__group_{key}" for key in keys}
    right = groups.withColumnsRenamed(renamed)
    match = reduce(and_, [F.col(key).eqNullSafe(F.col(new)) for key, new in renamed.items()])
    return rows.join(right, match, how).drop(*renamed.values())
