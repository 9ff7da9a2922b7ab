"""Derived columns of a cleaned record table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordwise.functions import dates, values
from recordwise.operators.cleaning import order_columns, with_row_index

# Edges, labels and column orders of the record model.
BUDGET_EDGES = (1, 10, 50, 100)
BUDGET_LABELS = ("Micro", "Low", "Medium", "High", "Blockbuster")
RATING_EDGES = (3, 5, 6.5, 7.5, 8.5)
RATING_LABELS = ("Poor", "Below Average", "Average", "Good", "Very Good", "Excellent")
BUDGET_TIER_EDGES = (10, 50, 100)
BUDGET_TIER_LABELS = ("Low (<$10M)", "Medium ($10M-$50M)", "High ($50M-$100M)", "Blockbuster (>$100M)")
RATING_TIER_EDGES = (5, 7, 8)
RATING_TIER_LABELS = ("Poor (<5.0)", "Average (5.0-7.0)", "Good (7.0-8.0)", "Excellent (>8.0)")

FULL_ORDER = (
    "id", "title", "tagline", "release_date", "release_year", "decade", "genres",
    "belongs_to_collection", "has_franchise", "original_language", "budget_musd", "budget_category",
    "revenue_musd", "profit_musd", "roi", "revenue_per_minute", "production_companies",
    "production_countries", "vote_count", "vote_average", "rating_category", "popularity",
    "popularity_score", "runtime", "overview", "spoken_languages", "poster_path", "backdrop_path",
    "cast", "cast_size", "director", "crew_size",
)
FINAL_COLUMNS = (
    "id", "title", "tagline", "release_date", "genres", "belongs_to_collection",
    "original_language", "budget_musd", "revenue_musd", "production_companies",
    "production_countries", "vote_count", "vote_average", "popularity", "runtime", "overview",
    "spoken_languages", "poster_path", "cast", "cast_size", "director", "crew_size", "profit_musd",
    "roi", "release_year",
)


def to_millions(df: DataFrame, columns: tuple[str, ...] = ("budget", "revenue")) -> DataFrame:
    """Add ``<column>_musd`` in millions and drop the original columns."""
    return df.withColumns({f"{c}_musd": values.in_millions(c) for c in columns}).drop(*columns)


def add_money(df: DataFrame) -> DataFrame:
    """Profit, return ratio and revenue per minute."""
    return df.withColumns(
        {
            "profit_musd": values.difference("revenue_musd", "budget_musd"),
            "roi": values.ratio_of_positive("revenue_musd", "budget_musd"),
            "revenue_per_minute": values.ratio_of_positive("revenue_musd", "runtime"),
        }
    )


def add_release_year(df: DataFrame, column: str = "release_date") -> DataFrame:
    return df.withColumn("release_year", dates.year_of(column))


def add_decade(df: DataFrame, year: str = "release_year") -> DataFrame:
    return df.withColumn("decade", dates.decade_of(year))


def add_date_parts(df: DataFrame, column: str = "release_date") -> DataFrame:
    return df.withColumns(
        {
            "year": dates.year_of(column),
            "month": dates.month_of(column),
            "quarter": dates.quarter_of(column),
        }
    )


def add_membership(df: DataFrame, column: str = "belongs_to_collection") -> DataFrame:
    return df.withColumn("has_franchise", F.col(column).isNotNull())


def add_membership_label(
    df: DataFrame, column: str = "belongs_to_collection", name: str = "is_franchise"
) -> DataFrame:
    return df.withColumn(name, values.label_if_present(column, "Franchise", "Standalone"))


def add_budget_category(df: DataFrame, null_label: str | None = None) -> DataFrame:
    return df.withColumn(
        "budget_category", values.bucket("budget_musd", BUDGET_EDGES, BUDGET_LABELS, null_label)
    )


def add_rating_category(df: DataFrame, null_label: str | None = None) -> DataFrame:
    return df.withColumn(
        "rating_category", values.bucket("vote_average", RATING_EDGES, RATING_LABELS, null_label)
    )


def add_budget_tier(df: DataFrame, null_label: str | None = None) -> DataFrame:
    return df.withColumn(
        "budget_tier", values.bucket("budget_musd", BUDGET_TIER_EDGES, BUDGET_TIER_LABELS, null_label)
    )


def add_rating_tier(df: DataFrame, null_label: str | None = None) -> DataFrame:
    return df.withColumn(
        "rating_tier", values.bucket("vote_average", RATING_TIER_EDGES, RATING_TIER_LABELS, null_label)
    )


def add_popularity_score(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "popularity_score", values.blended_score("vote_average", "vote_count", "popularity")
    )


def blank_unvoted_rating(
    df: DataFrame, rating: str = "vote_average", votes: str = "vote_count"
) -> DataFrame:
    """NULL rating where there are zero votes; an unknown vote count keeps its rating."""
    return df.withColumn(rating, F.when(F.col(votes) == 0, F.lit(None)).otherwise(F.col(rating)))


def derive_features(df: DataFrame, index: str | None = "index") -> DataFrame:
    """Cleaned table to the full feature table. All steps are narrow projections."""
    featured = (
        df.transform(to_millions)
        .transform(add_money)
        .transform(add_release_year)
        .transform(add_decade)
        .transform(add_membership)
        .transform(add_budget_category)
        .transform(add_rating_category)
        .transform(add_popularity_score)
        .transform(order_columns, FULL_ORDER)
    )
    return with_row_index(featured, index) if index else featured


def final_table(df: DataFrame) -> DataFrame:
    """Cleaned table to the analysis layout: money, year, adjusted rating, listed columns only."""
    return (
        df.transform(to_millions)
        .transform(add_money)
        .transform(add_release_year)
        .transform(blank_unvoted_rating)
        .transform(order_columns, FINAL_COLUMNS, keep_others=False)
    )
