"""KPI tables over the feature table. Output names are fixed values of the reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordwise.functions.values import ordinal
from recordwise.operators.features import BUDGET_LABELS, add_membership_label
from recordwise.operators.grouping import Report, agg_matrix, explode_values, group_metrics, reports_together
from recordwise.operators.ranking import rank_all
from recordwise.plans.rankings import RANKINGS

SKETCH_ACCURACY = 10_000
BIGGEST_FIRST = ("-total_revenue",)


def franchise_performance(df: DataFrame, accuracy: int = SKETCH_ACCURACY) -> DataFrame:
    """Members of a collection against the rest, with an approximate median return."""
    measures = {
        "mean_revenue": "avg(revenue_musd)",
        "median_roi": f"percentile_approx(roi, 0.5, {accuracy})",
        "mean_budget": "avg(budget_musd)",
        "mean_popularity": "avg(popularity)",
        "mean_rating": "avg(vote_average)",
        "movie_count": "count(id)",
    }
    return group_metrics(add_membership_label(df), ["is_franchise"], measures)


def successful_franchises(df: DataFrame) -> DataFrame:
    measures = {
        "movie_count": "count(id)",
        "total_budget": "sum(budget_musd)",
        "mean_budget": "avg(budget_musd)",
        "total_revenue": "sum(revenue_musd)",
        "mean_revenue": "avg(revenue_musd)",
        "mean_rating": "avg(vote_average)",
    }
    return group_metrics(
        df,
        ["belongs_to_collection"],
        measures,
        where="belongs_to_collection is not null",
        order_by=BIGGEST_FIRST,
    )


def successful_directors(df: DataFrame) -> DataFrame:
    measures = {
        "movie_count": "count(id)",
        "total_revenue": "sum(revenue_musd)",
        "mean_rating": "avg(vote_average)",
    }
    return group_metrics(
        df, ["director"], measures, where="director is not null", order_by=BIGGEST_FIRST
    )


def roi_by_genre(df: DataFrame) -> DataFrame:
    """One row per genre membership with a known return; no aggregation."""
    known = df.where("roi is not null").select("genres", "roi")
    return explode_values(known, "genres", "genre", drop_empty=True).select("genre", "roi")


def franchise_against_standalone(df: DataFrame) -> DataFrame:
    measures = {
        "movie_count": "count(1)",
        "mean_revenue": "avg(revenue_musd)",
        "mean_roi": "avg(roi)",
        "mean_budget": "avg(budget_musd)",
        "mean_popularity": "avg(popularity)",
        "mean_rating": "avg(vote_average)",
        "mean_profit": "avg(profit_musd)",
    }
    medians = {
        "median_revenue": ("revenue_musd", 0.5),
        "median_roi": ("roi", 0.5),
        "median_budget": ("budget_musd", 0.5),
    }
    layout = (
        "has_franchise movie_count mean_revenue median_revenue mean_roi median_roi mean_budget "
        "median_budget mean_popularity mean_rating mean_profit"
    ).split()
    return group_metrics(
        df, ["has_franchise"], measures, quantiles=medians, columns=layout, order_by=["-has_franchise"]
    )


def top_franchises_report() -> Report:
    measures = {
        "total_movies": "count(1)",
        "total_budget": "sum(budget_musd)",
        "mean_budget": "avg(budget_musd)",
        "total_revenue": "sum(revenue_musd)",
        "mean_revenue": "avg(revenue_musd)",
        "total_profit": "sum(profit_musd)",
        "mean_profit": "avg(profit_musd)",
        "mean_roi": "avg(roi)",
        "mean_rating": "avg(vote_average)",
        "mean_popularity": "avg(popularity)",
        "total_votes": "sum(vote_count)",
    }
    return Report(["belongs_to_collection"], measures, "has_franchise", order_by=BIGGEST_FIRST)


def top_franchises(df: DataFrame) -> DataFrame:
    return top_franchises_report().of(df)


def top_directors_report(min_movies: int = 1) -> Report:
    measures = {
        "total_movies": "count(1)",
        "total_revenue": "sum(revenue_musd)",
        "avg_revenue": "avg(revenue_musd)",
        "avg_rating": "avg(vote_average)",
        "total_profit": "sum(profit_musd)",
        "avg_profit": "avg(profit_musd)",
        "avg_roi": "avg(roi)",
        "total_votes": "sum(vote_count)",
        "avg_budget": "avg(budget_musd)",
    }
    return Report(["director"], measures, "director is not null", f"total_movies >= {min_movies}", order_by=BIGGEST_FIRST)


def top_directors(df: DataFrame, min_movies: int = 1) -> DataFrame:
    return top_directors_report(min_movies).of(df)


def genre_performance(df: DataFrame) -> DataFrame:
    measures = {
        "movie_count": "count(1)",
        "avg_revenue": "avg(revenue_musd)",
        "avg_roi": "avg(roi)",
        "avg_budget": "avg(budget_musd)",
        "avg_rating": "avg(vote_average)",
        "avg_popularity": "avg(popularity)",
        "total_revenue": "sum(revenue_musd)",
    }
    medians = {"median_revenue": ("revenue_musd", 0.5), "median_roi": ("roi", 0.5)}
    layout = (
        "genre movie_count avg_revenue median_revenue avg_roi median_roi avg_budget avg_rating "
        "avg_popularity total_revenue"
    ).split()
    return group_metrics(
        explode_values(df, "genres", "genre"),
        ["genre"],
        measures,
        quantiles=medians,
        columns=layout,
        order_by=BIGGEST_FIRST,
    )


def yearly_report() -> Report:
    measures = {
        "movies_released": "count(1)",
        "total_revenue": "sum(revenue_musd)",
        "avg_revenue": "avg(revenue_musd)",
        "total_budget": "sum(budget_musd)",
        "avg_budget": "avg(budget_musd)",
        "avg_roi": "avg(roi)",
        "avg_rating": "avg(vote_average)",
        "avg_popularity": "avg(popularity)",
    }
    return Report(["release_year"], measures, order_by=["release_year"])


def yearly_trends(df: DataFrame) -> DataFrame:
    return yearly_report().of(df)


def decade_report() -> Report:
    measures = {
        "movies_released": "count(1)",
        "total_revenue": "sum(revenue_musd)",
        "avg_revenue": "avg(revenue_musd)",
        "avg_budget": "avg(budget_musd)",
        "avg_roi": "avg(roi)",
        "avg_rating": "avg(vote_average)",
    }
    return Report(["decade"], measures, order_by=["decade"])


def decade_trends(df: DataFrame) -> DataFrame:
    return decade_report().of(df)


def language_report(min_movies: int = 2) -> Report:
    measures = {
        "movie_count": "count(1)",
        "avg_revenue": "avg(revenue_musd)",
        "avg_budget": "avg(budget_musd)",
        "avg_rating": "avg(vote_average)",
        "total_revenue": "sum(revenue_musd)",
    }
    return Report(["original_language"], measures, having=f"movie_count >= {min_movies}", order_by=BIGGEST_FIRST)


def language_performance(df: DataFrame, min_movies: int = 2) -> DataFrame:
    return language_report(min_movies).of(df)


def budget_category_report() -> Report:
    measures = {
        "movie_count": "count(1)",
        "avg_revenue": "avg(revenue_musd)",
        "avg_roi": "avg(roi)",
        "avg_rating": "avg(vote_average)",
        "avg_popularity": "avg(popularity)",
    }
    return Report(["budget_category"], measures)


def by_budget(rows: DataFrame) -> DataFrame:
    return rows.orderBy(ordinal("budget_category", BUDGET_LABELS))


def budget_category_performance(df: DataFrame) -> DataFrame:
    return by_budget(budget_category_report().of(df))


def summary_statistics(df: DataFrame) -> DataFrame:
    """One row of totals, averages, extremes and distinct counts.

    The distinct count runs on its own narrow column: within the same aggregation it would
    carry all other totals through its shuffle.
    """
    measures = {
        "total_movies": "count(1)",
        "total_revenue": "sum(revenue_musd)",
        "total_budget": "sum(budget_musd)",
        "total_profit": "sum(profit_musd)",
        "avg_revenue": "avg(revenue_musd)",
        "avg_budget": "avg(budget_musd)",
        "avg_roi": "avg(roi)",
        "avg_rating": "avg(vote_average)",
        "avg_popularity": "avg(popularity)",
        "max_revenue": "max(revenue_musd)",
        "min_revenue": "min(revenue_musd)",
        "franchise_movies": "count_if(has_franchise)",
    }
    layout = (
        "total_movies total_revenue total_budget total_profit avg_revenue median_revenue avg_budget "
        "avg_roi avg_rating avg_popularity max_revenue min_revenue unique_directors franchise_movies"
    ).split()
    totals = group_metrics(df, [], measures, quantiles={"median_revenue": ("revenue_musd", 0.5)})
    return totals.withColumn("unique_directors", distinct_values(df, "director")).select(*layout)


def distinct_values(df: DataFrame, column: str):
    """Number of distinct known values of a column, as a scalar subquery."""
    return df.agg(F.count_distinct(column)).scalar()


FRANCHISE_MATRIX = {
    "columns": ("budget_musd", "revenue_musd", "profit_musd", "roi", "vote_average", "popularity"),
    "aggregations": ("count", "sum", "mean", "median", "std"),
}


def franchise_matrix(
    df: DataFrame, columns: Sequence[str] | None = None, aggregations: Sequence[str] | None = None
) -> DataFrame:
    wanted = {**FRANCHISE_MATRIX}
    wanted |= {k: v for k, v in (("columns", columns), ("aggregations", aggregations)) if v}
    return agg_matrix(df.where("has_franchise"), ["belongs_to_collection"], **wanted)


def all_kpis(
    df: DataFrame, top: int = 10, rankings: Sequence[Mapping] = RANKINGS, min_director_movies: int = 1
) -> dict[str, DataFrame | dict[str, DataFrame]]:
    """Every KPI by name. Give a stage table that was read back, not a long lineage: each
    entry scans it once, reading only its own columns."""
    return {
        "rankings": rank_all(df, rankings, top),
        "franchise_comparison": franchise_against_standalone(df),
        "top_franchises": top_franchises(df),
        "top_directors": top_directors(df, min_director_movies),
        "genre_performance": genre_performance(df),
        "yearly_trends": yearly_trends(df),
        "decade_trends": decade_trends(df),
        "language_performance": language_performance(df),
        "budget_category_performance": budget_category_performance(df),
        "summary_statistics": summary_statistics(df),
    }


def plain_kpis(df: DataFrame, min_director_movies: int = 1) -> dict[str, DataFrame]:
    """The KPI tables with plain keys, from one scan and one shuffle; the rows of the single functions."""
    reports = {
        "top_franchises": top_franchises_report(),
        "top_directors": top_directors_report(min_director_movies),
        "yearly_trends": yearly_report(),
        "decade_trends": decade_report(),
        "language_performance": language_report(),
        "budget_category_performance": budget_category_report(),
    }
    tables = reports_together(df, reports)
    return tables | {"budget_category_performance": by_budget(tables["budget_category_performance"])}
