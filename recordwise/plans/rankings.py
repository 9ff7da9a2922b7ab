"""The ten ranking reports."""

from __future__ import annotations

from pyspark.sql import DataFrame

from recordwise.operators.ranking import rank_all

# Ranked column, direction and floor of every report.
RANKINGS = (
    {"name": "highest_revenue", "column": "revenue_musd"},
    {"name": "highest_budget", "column": "budget_musd"},
    {"name": "highest_profit", "column": "profit_musd"},
    {"name": "lowest_profit", "column": "profit_musd", "ascending": True},
    {"name": "highest_roi", "column": "roi", "filter": "budget_musd >= 10"},
    {"name": "lowest_roi", "column": "roi", "ascending": True, "filter": "budget_musd >= 10"},
    {"name": "most_voted", "column": "vote_count"},
    {"name": "highest_rated", "column": "vote_average", "filter": "vote_count >= 10"},
    {"name": "lowest_rated", "column": "vote_average", "ascending": True, "filter": "vote_count >= 10"},
    {"name": "most_popular", "column": "popularity"},
)


def all_rankings(df: DataFrame, n: int = 10) -> dict[str, DataFrame]:
    return rank_all(df, RANKINGS, n)
