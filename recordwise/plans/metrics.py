"""Aggregated metric tables over the feature table. Output names are fixed values."""

from __future__ import annotations

from pyspark.sql import DataFrame

from recordwise.operators.charts import correlations
from recordwise.operators.features import add_budget_tier, add_date_parts, add_rating_tier
from recordwise.operators.grouping import Report, explode_values, group_metrics, reports_together
from recordwise.operators.value_lists import group_members
from recordwise.plans.kpis import distinct_values

BIGGEST_FIRST = ("-total_revenue",)
REVENUE = {"total_revenue": "sum(revenue_musd)", "avg_revenue": "avg(revenue_musd)"}
AUDIENCE = {"avg_rating": "avg(vote_average)", "avg_popularity": "avg(popularity)"}
RELEASE_SPAN = {"first_release": "min(release_date)", "latest_release": "max(release_date)"}
LEVELS = {"year": ["year"], "quarter": ["year", "quarter"], "month": ["year", "month"]}


def temporal_report(level: str = "year") -> Report:
    measures = {
        "movie_count": "count(1)",
        **REVENUE,
        "total_budget": "sum(budget_musd)",
        "avg_budget": "avg(budget_musd)",
        **AUDIENCE,
        "avg_runtime": "avg(runtime)",
    }
    return Report(LEVELS[level], measures, order_by=LEVELS[level])


def temporal_metrics(df: DataFrame, level: str = "year") -> DataFrame:
    """Metrics per year, per quarter or per month."""
    return temporal_report(level).of(add_date_parts(df))


def genre_metrics(df: DataFrame) -> DataFrame:
    measures = {
        "movie_count": "count(1)",
        **REVENUE,
        "avg_budget": "avg(budget_musd)",
        **AUDIENCE,
        "profitable_count": "count_if(revenue_musd > budget_musd)",
    }
    return group_metrics(
        explode_values(df, "genres", "genre"),
        ["genre"],
        measures,
        derived={"profitability_rate": "round(profitable_count / movie_count * 100, 2)"},
        order_by=BIGGEST_FIRST,
    )


def language_report(min_movies: int = 5) -> Report:
    measures = {"movie_count": "count(1)", **REVENUE, **AUDIENCE}
    return Report(["original_language"], measures, having=f"movie_count >= {min_movies}", order_by=BIGGEST_FIRST)


def language_metrics(df: DataFrame, min_movies: int = 5) -> DataFrame:
    return language_report(min_movies).of(df)


def company_metrics(df: DataFrame, min_movies: int = 3) -> DataFrame:
    measures = {
        "movie_count": "count(1)",
        **REVENUE,
        "avg_rating": "avg(vote_average)",
        "max_revenue": "max(revenue_musd)",
        **RELEASE_SPAN,
    }
    return group_metrics(
        explode_values(df, "production_companies", "company"),
        ["company"],
        measures,
        having=f"movie_count >= {min_movies}",
        order_by=BIGGEST_FIRST,
    )


def director_report(min_movies: int = 2) -> Report:
    measures = {"movie_count": "count(1)", **REVENUE, **AUDIENCE}
    return Report(["director"], measures, "director is not null", f"movie_count >= {min_movies}", order_by=["-total_revenue", "director"])


def director_metrics(df: DataFrame, min_movies: int = 2) -> DataFrame:
    """One row per director; the titles are in ``director_members``."""
    return director_report(min_movies).of(df)


def director_members(df: DataFrame, min_movies: int = 2) -> DataFrame:
    """One row per record of the directors of ``director_metrics``."""
    known = df.where("director is not null")
    groups = group_metrics(known, ["director"], {"movie_count": "count(1)"}, having=f"movie_count >= {min_movies}")
    return group_members(known, groups, ["director"], ["id", "title"])


def franchise_report() -> Report:
    measures = {
        "movie_count": "count(1)",
        **REVENUE,
        "total_budget": "sum(budget_musd)",
        "avg_budget": "avg(budget_musd)",
        "avg_rating": "avg(vote_average)",
        **RELEASE_SPAN,
    }
    derived = {
        "total_profit": "total_revenue - total_budget",
        "avg_roi": "round(try_divide(total_revenue, total_budget), 2)",
    }
    known = "belongs_to_collection is not null"
    return Report(["belongs_to_collection"], measures, known, derived=derived, order_by=["-total_revenue", "belongs_to_collection"])


def franchise_metrics(df: DataFrame) -> DataFrame:
    """Collection metrics with total profit and return on the sums; the titles are in ``franchise_members``."""
    return franchise_report().of(df)


def franchise_members(df: DataFrame) -> DataFrame:
    """One row per record of a collection."""
    return df.where("belongs_to_collection is not null").select("belongs_to_collection", "id", "title")


def budget_tier_report() -> Report:
    measures = {
        "movie_count": "count(1)",
        "avg_budget": "avg(budget_musd)",
        "avg_revenue": "avg(revenue_musd)",
        **AUDIENCE,
        "avg_roi_pct": "avg(try_divide(revenue_musd - budget_musd, budget_musd) * 100)",
    }
    return Report(["budget_tier"], measures, order_by=["budget_tier"])


def budget_tier_metrics(df: DataFrame, null_label: str | None = None) -> DataFrame:
    return budget_tier_report().of(add_budget_tier(df, null_label))


def rating_tier_report() -> Report:
    measures = {
        "movie_count": "count(1)",
        "avg_revenue": "avg(revenue_musd)",
        "avg_budget": "avg(budget_musd)",
        "avg_popularity": "avg(popularity)",
        "avg_vote_count": "avg(vote_count)",
    }
    return Report(["rating_tier"], measures, order_by=["rating_tier"])


def rating_tier_metrics(df: DataFrame, null_label: str | None = None) -> DataFrame:
    return rating_tier_report().of(add_rating_tier(df, null_label))


CORRELATED = {
    "budget_revenue": ("budget_musd", "revenue_musd"),
    "budget_rating": ("budget_musd", "vote_average"),
    "revenue_rating": ("revenue_musd", "vote_average"),
    "popularity_revenue": ("popularity", "revenue_musd"),
    "votes_rating": ("vote_count", "vote_average"),
}


def correlation_metrics(df: DataFrame, null_policy: str = "pairwise") -> DataFrame:
    return correlations(
        df, CORRELATED, "budget_musd is not null and revenue_musd is not null", null_policy
    )


def summary_sections(df: DataFrame, digits: int = 2) -> DataFrame:
    """Overview, financial and quality figures as rows (section, metric, value)."""
    sections = {
        "overview": {"total_movies": "count(1)"},
        "financial": {
            "total_revenue_musd": "sum(revenue_musd)",
            "avg_revenue_musd": "avg(revenue_musd)",
            "min_revenue_musd": "min(revenue_musd)",
            "max_revenue_musd": "max(revenue_musd)",
            "avg_budget_musd": "avg(budget_musd)",
        },
        "quality": {
            "avg_rating": "avg(vote_average)",
            "avg_popularity": "avg(popularity)",
            "avg_runtime_min": "avg(runtime)",
        },
    }
    distinct = {"unique_directors": "director", "unique_languages": "original_language"}
    one_row = group_metrics(df, [], {m: sql for part in sections.values() for m, sql in part.items()})
    one_row = one_row.withColumns({m: distinct_values(df, c) for m, c in distinct.items()})
    places = [(s, m) for s, part in sections.items() for m in part] + [("overview", m) for m in distinct]
    entries = [
        f"named_struct('section', '{section}', 'metric', '{metric}', 'value', round(cast({metric} as double), {digits}))"
        for section, metric in places
    ]
    return one_row.selectExpr(f"inline(array({', '.join(entries)}))")


METRIC_TABLES = {
    "temporal": temporal_metrics,
    "genre": genre_metrics,
    "language": language_metrics,
    "production_company": company_metrics,
    "director": director_metrics,
    "franchise": franchise_metrics,
    "director_members": director_members,
    "franchise_members": franchise_members,
    "budget_tier": budget_tier_metrics,
    "rating_tier": rating_tier_metrics,
}


def plain_tables(df: DataFrame) -> dict[str, DataFrame]:
    """The metric tables with plain keys, from one scan and one shuffle; the rows of the single functions."""
    reports = {
        "temporal": temporal_report(),
        "language": language_report(),
        "director": director_report(),
        "franchise": franchise_report(),
        "budget_tier": budget_tier_report(),
        "rating_tier": rating_tier_report(),
    }
    return reports_together(df.transform(add_date_parts).transform(add_budget_tier).transform(add_rating_tier), reports)
