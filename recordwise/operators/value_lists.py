"""The members of groups, as a relation of their own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from recordwise.operators.joins import join_on_groups


def group_members(rows: DataFrame, groups: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per member of each of ``groups``: the keys and ``columns``.

    A list of members inside a group's row would grow with the group; rows do not, so a group of
    any size looks the same and no task holds one whole.
    """
    keys = list(keys)
    return join_on_groups(rows.select(*keys, *columns), groups.select(*keys), keys)
