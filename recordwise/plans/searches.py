"""Searches over the feature table, and the two group reports that belong to them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from recordwise.operators.grouping import explode_values, group_metrics
from recordwise.operators.search import find, in_range, top_in_value
from recordwise.operators.value_lists import group_members

# The two configured searches and their output columns.
GENRE_CAST_SEARCH = {
    "genres": ("Science Fiction", "Action"),
    "cast": "Bruce Willis",
    "sort_by": "vote_average",
    "ascending": False,
}
CAST_DIRECTOR_SEARCH = {
    "cast": "Uma Thurman",
    "director": "Quentin Tarantino",
    "sort_by": "runtime",
    "ascending": True,
}
GENRE_CAST_COLUMNS = (
    "id", "title", "release_year", "genres", "vote_average", "vote_count", "popularity",
    "budget_musd", "revenue_musd", "profit_musd", "roi", "cast", "director", "runtime",
)
CAST_DIRECTOR_COLUMNS = (
    "id", "title", "release_year", "genres", "runtime", "vote_average", "vote_count", "budget_musd",
    "revenue_musd", "profit_musd", "cast", "director", "tagline",
)


def by_genres_and_cast(
    df: DataFrame,
    genres: Sequence[str],
    cast: str,
    sort_by: str = "vote_average",
    ascending: bool = False,
    match: str = "exact",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    wanted = [("genres", genre) for genre in genres] + [("cast", cast)]
    return find(df, wanted, sort_by=sort_by, ascending=ascending, match=match, columns=columns)


def by_cast_and_director(
    df: DataFrame,
    cast: str,
    director: str,
    sort_by: str = "runtime",
    ascending: bool = True,
    match: str = "exact",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    return find(
        df, [("cast", cast)], [("director", director)], sort_by, ascending, match, columns=columns
    )


def genre_cast_search(df: DataFrame, search: Mapping | None = None, match: str = "exact") -> DataFrame:
    return by_genres_and_cast(
        df, **{**GENRE_CAST_SEARCH, **(search or {})}, match=match, columns=GENRE_CAST_COLUMNS
    )


def cast_director_search(df: DataFrame, search: Mapping | None = None, match: str = "exact") -> DataFrame:
    return by_cast_and_director(
        df, **{**CAST_DIRECTOR_SEARCH, **(search or {})}, match=match, columns=CAST_DIRECTOR_COLUMNS
    )


def both_searches(
    df: DataFrame, genre_cast: Mapping | None = None, cast_director: Mapping | None = None
) -> dict[str, DataFrame]:
    """The two searches in full width; whole-value match on cast, text match on genres."""
    first = {**GENRE_CAST_SEARCH, **(genre_cast or {})}
    second = {**CAST_DIRECTOR_SEARCH, **(cast_director or {})}
    narrowed = find(df, [("genres", genre) for genre in first["genres"]], match="substring")
    return {
        "genre_cast": find(
            narrowed, [("cast", first["cast"])], sort_by=first["sort_by"], ascending=first["ascending"]
        ),
        "cast_director": by_cast_and_director(df, **second),
    }


def by_years(df: DataFrame, start: int, end: int, min_rating: float = 0.0) -> DataFrame:
    return in_range(df, "release_year", start, end).where(f"vote_average >= {min_rating}")


def by_budget(df: DataFrame, low: float, high: float) -> DataFrame:
    return in_range(df, "budget_musd", low, high)


def best_roi_in_genre(
    df: DataFrame, genre: str, n: int = 10, min_budget: float = 1.0, match: str = "exact"
) -> DataFrame:
    return top_in_value(df, "genres", genre, "roi", n, f"budget_musd >= {min_budget}", match)


def _collaborating(df: DataFrame) -> DataFrame:
    columns = df.select("id", "title", "director", "cast", "vote_average", "revenue_musd")
    return explode_values(columns, "cast", "actor")


def collaborations(df: DataFrame, minimum: int = 2) -> DataFrame:
    """Director and cast member pairs with shared records; records without director count too."""
    return group_metrics(
        _collaborating(df),
        ["director", "actor"],
        {
            "movies_together": "count(1)",
            "avg_rating": "avg(vote_average)",
            "total_revenue": "sum(revenue_musd)",
        },
        having=f"movies_together >= {minimum}",
        order_by=["-movies_together", "director", "actor"],
    )


def collaboration_members(df: DataFrame, minimum: int = 2) -> DataFrame:
    """One row per shared record of the pairs of ``collaborations``."""
    pairs = _collaborating(df)
    groups = group_metrics(pairs, ["director", "actor"], {"n": "count(1)"}, having=f"n >= {minimum}")
    return group_members(pairs, groups, ["director", "actor"], ["id", "title"])


def compare_decades(df: DataFrame, first: int, second: int) -> DataFrame:
    measures = {
        "movie_count": "count(1)",
        "avg_revenue": "avg(revenue_musd)",
        "avg_budget": "avg(budget_musd)",
        "avg_roi": "avg(roi)",
        "avg_rating": "avg(vote_average)",
        "avg_popularity": "avg(popularity)",
    }
    return group_metrics(df, ["decade"], measures, where=f"decade in ({first}, {second})")
