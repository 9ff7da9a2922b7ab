"""Datasets behind the dashboards: aggregates and bounded samples, without drawing.

Column names, bin counts, floors and limits are fixed values of the charts.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordwise.functions import values
from recordwise.functions.nested import first_token
from recordwise.operators import charts
from recordwise.operators.features import (
    BUDGET_TIER_EDGES,
    add_budget_tier,
    add_date_parts,
    add_membership_label,
)
from recordwise.operators.grouping import AGGREGATES, explode_values, group_metrics
from recordwise.operators.ranking import top_n
from recordwise.operators.sizing import settle
from recordwise.plans.kpis import distinct_values, roi_by_genre

BOTH_POSITIVE = "budget_musd > 0 and revenue_musd > 0"
ROI_PERCENT = "(try_divide(revenue_musd, budget_musd) - 1) * 100"
ROI_SPAN = (-100.0, 500.0)
SHORT_TIERS = ("Low", "Medium", "High", "Blockbuster")


def _genres(df: DataFrame, *columns: str) -> DataFrame:
    """One row per genre membership with only the named columns."""
    return explode_values(df.select("genres", *columns), "genres", "genre").drop("genres")


def genre_years(df: DataFrame) -> DataFrame:
    """Sums and counts per genre and year: the common ground of the genre charts.

    One explode and one shuffle of few rows. Averages follow as sums over counts, so every
    genre chart can be made from this table instead of the records.
    """
    measured = ("revenue_musd", "budget_musd", "vote_average", "popularity")
    sums = {f"{c}_sum": f"sum({c})" for c in measured} | {f"{c}_n": f"count({c})" for c in measured}
    members = _genres(add_date_parts(df), "year", *measured)
    return group_metrics(members, ["genre", "year"], {"n": "count(1)", **sums})


def _summary(df: DataFrame, summary: DataFrame | None) -> DataFrame:
    return genre_years(df) if summary is None else summary


def _mean(column: str) -> str:
    return f"try_divide(sum({column}_sum), sum({column}_n))"


def _with_roi(df: DataFrame, where: str) -> DataFrame:
    return df.where(where).withColumn("roi", F.expr(ROI_PERCENT))


def executive_kpis(df: DataFrame) -> DataFrame:
    gain = f"avg(case when {BOTH_POSITIVE} then {ROI_PERCENT} end)"
    return group_metrics(
        df,
        [],
        {
            "total_movies": "count(1)",
            "total_revenue": "coalesce(sum(revenue_musd), 0)",
            "total_budget": "coalesce(sum(budget_musd), 0)",
            "avg_rating": "coalesce(avg(vote_average), 0)",
            "avg_roi": f"coalesce({gain}, 0)",
        },
    )


def most_frequent_genre(df: DataFrame, summary: DataFrame | None = None) -> DataFrame:
    return genres_by_count(df, 1, summary)


def money_scatter(df: DataFrame, n: int) -> DataFrame:
    points = df.where(BOTH_POSITIVE).select("id", "budget_musd", "revenue_musd", "vote_average")
    return charts.repeatable_sample(points, n)


def money_scatter_detailed(df: DataFrame, n: int) -> DataFrame:
    points = _with_roi(df, BOTH_POSITIVE).select(
        "id",
        "title",
        "budget_musd",
        "revenue_musd",
        "vote_average",
        "genres",
        "release_date",
        values.difference("revenue_musd", "budget_musd").alias("profit_musd"),
        F.col("roi").alias("roi_percent"),
    )
    return charts.repeatable_sample(points, n)


def genres_by_revenue(df: DataFrame, n: int = 10, summary: DataFrame | None = None) -> DataFrame:
    return top_n(genre_sunburst(df, summary), "total_revenue", n, key="genre")


def genres_by_count(df: DataFrame, n: int = 15, summary: DataFrame | None = None) -> DataFrame:
    counted = group_metrics(_summary(df, summary), ["genre"], {"count": "sum(n)"})
    return top_n(counted, "count", n, key="genre")


def rating_histogram(df: DataFrame, bins: int = 20) -> DataFrame:
    return charts.histogram(df, "vote_average", bins)


def roi_histogram(df: DataFrame, bins: int = 30) -> DataFrame:
    return charts.histogram(df, ROI_PERCENT, bins, BOTH_POSITIVE, ROI_SPAN)


def vote_histogram(df: DataFrame, bins: int = 50) -> DataFrame:
    return charts.histogram(df, "vote_count", bins, "vote_count > 0")


def revenue_histogram(df: DataFrame, bins: int = 50) -> DataFrame:
    return charts.histogram(df, "revenue_musd", bins, "revenue_musd > 0")


def overview_totals(df: DataFrame) -> DataFrame:
    totals = group_metrics(
        df,
        [],
        {
            "total_movies": "count(1)",
            "total_revenue": "sum(revenue_musd)",
            "avg_revenue": "avg(revenue_musd)",
            "total_budget": "sum(budget_musd)",
            "avg_rating": "avg(vote_average)",
        },
    )
    return totals.withColumns(
        {
            "languages": distinct_values(df, "original_language"),
            "directors": distinct_values(df, "director"),
        }
    )


def yearly_revenue(df: DataFrame, known_years_only: bool = False) -> DataFrame:
    measures = {
        "total_revenue": "sum(revenue_musd)",
        "avg_revenue": "avg(revenue_musd)",
        "movie_count": "count(1)",
    }
    dated = add_date_parts(df)
    where = "year is not null" if known_years_only else None
    return group_metrics(dated, ["year"], measures, where=where, order_by=["year"])


def yearly_money(df: DataFrame) -> DataFrame:
    measures = {"total_revenue": "sum(revenue_musd)", "total_budget": "sum(budget_musd)"}
    return group_metrics(
        df, ["release_year"], measures, where="release_year is not null", order_by=["release_year"]
    )


def budget_tier_share(df: DataFrame) -> DataFrame:
    return charts.share_of_total(group_metrics(add_budget_tier(df), ["budget_tier"], {"count": "count(1)"}))


def _bars(df: DataFrame, by: str, n: int, extra: Sequence[str] = (), where: str | None = None) -> DataFrame:
    bars = top_n(df, by, n, where=where, columns=["title", by, *extra, "id"])
    return bars.withColumn("label", values.shorten("title", 20))


def top_revenue_bars(df: DataFrame, n: int = 10) -> DataFrame:
    return _bars(df, "revenue_musd", n, ["vote_average"])


def top_roi_bars(df: DataFrame, n: int = 10) -> DataFrame:
    return _bars(_with_roi(df, "budget_musd >= 10 and revenue_musd > 0"), "roi", n)


def top_popularity_bars(df: DataFrame, n: int = 10) -> DataFrame:
    return _bars(df, "popularity", n)


def top_rating_bars(df: DataFrame, n: int = 10) -> DataFrame:
    return _bars(df, "vote_average", n, ["vote_count"], "vote_count >= 100")


def profit_scatter(df: DataFrame, n: int) -> DataFrame:
    profit = values.difference("revenue_musd", "budget_musd").alias("profit")
    return charts.repeatable_sample(df.where(BOTH_POSITIVE).select("id", "budget_musd", profit), n)


def top_companies(df: DataFrame, n: int = 10, minimum: int = 3) -> DataFrame:
    members = explode_values(df.select("production_companies", "revenue_musd"), "production_companies", "company")
    measures = {"total_revenue": "sum(revenue_musd)", "movie_count": "count(1)"}
    grouped = group_metrics(members, ["company"], measures, having=f"movie_count >= {minimum}")
    return top_n(grouped, "total_revenue", n, key="company").withColumn(
        "label", values.shorten("company", 25)
    )


def membership_bars(df: DataFrame) -> DataFrame:
    labelled = add_membership_label(df, name="type")
    measures = {"avg_revenue": "avg(revenue_musd)", "avg_budget": "avg(budget_musd)", "count": "count(1)"}
    return group_metrics(labelled, ["type"], measures)


def rating_popularity_scatter(df: DataFrame, n: int) -> DataFrame:
    points = df.where("vote_count >= 100").select("id", "vote_average", "popularity", "vote_count")
    return charts.repeatable_sample(points, n)


def rating_by_genre(df: DataFrame, n: int = 8) -> DataFrame:
    """Rating distribution of the ``n`` genres with most rated records."""
    rated = _genres(df.where("vote_average is not null"), "vote_average")
    top = charts.top_groups(rated, "genre", "count(1)", n)
    return charts.box_stats(charts.only_groups(rated, top, "genre"), ["genre"], "vote_average", ["-count", "genre"])


def yearly_rating_band(df: DataFrame) -> DataFrame:
    return charts.band_around_mean(add_date_parts(df), "year", "vote_average", "rating")


def genre_heatmap(
    df: DataFrame, n: int = 12, minimum: int = 5, summary: DataFrame | None = None
) -> DataFrame:
    """Average metrics of the top genres, each also scaled to 0..1 over these genres."""
    averages = {
        "avg_revenue": _mean("revenue_musd"),
        "avg_budget": _mean("budget_musd"),
        "avg_rating": _mean("vote_average"),
        "avg_popularity": _mean("popularity"),
    }
    grouped = group_metrics(
        _summary(df, summary), ["genre"], {**averages, "count": "sum(n)"}, having=f"count >= {minimum}"
    )
    return charts.min_max_scaled(top_n(grouped, "avg_revenue", n, key="genre"), tuple(averages))


def genre_roi_bars(df: DataFrame, n: int = 10, minimum: int = 5) -> DataFrame:
    members = _genres(_with_roi(df, "budget_musd > 10 and revenue_musd > 0"), "roi")
    grouped = group_metrics(
        members, ["genre"], {"avg_roi": "avg(roi)", "count": "count(1)"}, having=f"count >= {minimum}"
    )
    band = values.bucket("avg_roi", (100, 0), ("green", "orange", "red"), above=True)
    return top_n(grouped, "avg_roi", n, key="genre").withColumn("band", band)


def genre_bubbles(df: DataFrame, minimum: int = 5, summary: DataFrame | None = None) -> DataFrame:
    measures = {"avg_revenue": _mean("revenue_musd"), "avg_rating": _mean("vote_average"), "count": "sum(n)"}
    return group_metrics(_summary(df, summary), ["genre"], measures, having=f"count >= {minimum}")


def genre_evolution(df: DataFrame, n: int = 5, summary: DataFrame | None = None) -> DataFrame:
    """Yearly revenue of the ``n`` genres with most revenue.

    The summary is read twice, to find the genres and to list their years, so it is
    settled first.
    """
    if summary is None:
        summary = settle(genre_years(df))
    by_year = summary.select("genre", "year", F.col("revenue_musd_sum").alias("revenue"))
    top = charts.top_groups(by_year, "genre", "sum(revenue)", n)
    return charts.ordered(charts.only_groups(by_year, top, "genre"), "genre", "year")


def genre_sunburst(df: DataFrame, summary: DataFrame | None = None) -> DataFrame:
    measures = {"total_revenue": "sum(revenue_musd_sum)", "count": "sum(n)"}
    return group_metrics(_summary(df, summary), ["genre"], measures)


def roi_by_genre_boxes(df: DataFrame, n: int = 12) -> DataFrame:
    """Return distribution of the ``n`` genres with most records in the shown span."""
    low, high = ROI_SPAN
    members = _genres(
        _with_roi(df, "budget_musd >= 10 and revenue_musd > 0").where(f"roi between {low} and {high}"), "roi"
    )
    top = charts.top_groups(members, "genre", "count(1)", n)
    return charts.box_stats(charts.only_groups(members, top, "genre"), ["genre"], "roi", ["-count", "genre"])


def performance_points(df: DataFrame, n: int) -> DataFrame:
    points = df.where(f"{BOTH_POSITIVE} and vote_average > 0").select(
        "id", "title", "budget_musd", "revenue_musd", "vote_average", "popularity", "genres"
    )
    return charts.repeatable_sample(points, n)


def revenue_treemap(df: DataFrame, n: int = 50) -> DataFrame:
    top = top_n(df, "revenue_musd", n, columns=["id", "title", "revenue_musd", "genres", "vote_average"])
    return top.withColumn("primary_genre", first_token("genres"))


def genre_year_ratings(df: DataFrame, summary: DataFrame | None = None) -> DataFrame:
    """Average rating per genre and year, one row each."""
    rating = F.try_divide(F.col("vote_average_sum"), F.col("vote_average_n"))
    return _summary(df, summary).select("genre", "year", rating.alias("avg_rating"))


def rating_heatmap(df: DataFrame, years: Sequence[int], summary: DataFrame | None = None) -> DataFrame:
    """Average rating per genre (rows) and year (columns ``y<year>``)."""
    return charts.matrix(_summary(df, summary), "genre", "year", _mean("vote_average"), years, prefix="y")


def roi_by_tier_boxes(df: DataFrame) -> DataFrame:
    low, high = ROI_SPAN
    tier = values.bucket("budget_musd", BUDGET_TIER_EDGES, SHORT_TIERS)
    rows = _with_roi(df, BOTH_POSITIVE).where(f"roi between {low} and {high}").withColumn("budget_tier", tier)
    boxes = charts.box_stats(rows, ["budget_tier"], "roi")
    return boxes.orderBy(values.ordinal("budget_tier", SHORT_TIERS))


def average_roi_by_genre(df: DataFrame) -> DataFrame:
    return group_metrics(roi_by_genre(df), ["genre"], {"avg_roi": "avg(roi)"}, order_by=["-avg_roi", "genre"])


def annotated_top(df: DataFrame, n: int = 3) -> DataFrame:
    known = df.where("budget_musd is not null and revenue_musd is not null")
    return top_n(known, "revenue_musd", n, columns=["id", "title", "budget_musd", "revenue_musd"])


def rating_violin(df: DataFrame) -> DataFrame:
    return charts.box_stats(df, [], "vote_average")


def money_pairs(df: DataFrame) -> DataFrame:
    """All budget and revenue pairs that are both known."""
    return df.select("id", "title", "budget_musd", "revenue_musd").dropna(subset=["budget_musd", "revenue_musd"])


def popularity_pairs(df: DataFrame) -> DataFrame:
    return df.select("id", "popularity", "vote_average").dropna(subset=["popularity", "vote_average"])


MULTI_VALUED = ("genres", "production_companies", "production_countries", "spoken_languages")


def declared_chart(df: DataFrame, spec: Mapping) -> DataFrame:
    """The dataset of a chart declared as ``type``, ``x``, ``y`` and, by type, ``color``, ``size``, ``aggregation``, ``points``.

    A scatter gives the rows that have x and y, all of them or, where ``points`` is given, a repeatable sample of
    that size (``declared_cells`` counts all in a grid), a box the quartiles of y for each value of x, a line or bar the aggregation of each y for each value of x. A multi-valued x
    counts once for each of its values.
    """
    kind, x = spec["type"], spec["x"]
    ys = [spec["y"]] if isinstance(spec["y"], str) else list(spec["y"])
    if kind == "scatter":
        shown = dict.fromkeys(["id", x, *ys, *[spec[c] for c in ("color", "size") if c in spec]])
        known = df.select(*shown).dropna(subset=[x, *ys])
        return charts.repeatable_sample(known, spec["points"]) if spec.get("points") is not None else known
    rows = df.select(x, *ys)
    if x in MULTI_VALUED:
        rows = explode_values(rows.withColumnRenamed(x, "__values"), "__values", x).drop("__values")
    if kind == "box":
        return charts.box_stats(rows, [x], ys[0], [x])
    if kind not in ("line", "bar"):
        raise ValueError(f"unknown chart type {kind!r}")
    how = spec.get("aggregation", "mean")
    if how == "median":
        return group_metrics(rows, [x], {}, quantiles={y: (f"`{y}`", 0.5) for y in ys}, order_by=[x])
    return group_metrics(rows, [x], {f"{y}_{how}": AGGREGATES[how].format(c=f"`{y}`") for y in ys}, order_by=[x])


def declared_cells(df: DataFrame, spec: Mapping, bins: int = 50) -> dict[str, DataFrame]:
    """All rows behind a declared scatter, counted in a grid for each of its ys; none for other charts."""
    if spec["type"] != "scatter":
        return {}
    ys = [spec["y"]] if isinstance(spec["y"], str) else list(spec["y"])
    names = {y: f"cells_{y}" if len(ys) > 1 else "cells" for y in ys}
    known = df.dropna(subset=[spec["x"], *ys])
    return {name: charts.grid_counts(known, f"`{spec['x']}`", f"`{y}`", bins) for y, name in names.items()}


def chart_name(spec: Mapping) -> str:
    """A folder name from the chart's title, or from its axes."""
    title = spec.get("title") or f"{spec['type']} {spec['x']} {spec['y']}"
    return re.sub(r"\W+", "_", title.lower()).strip("_")


# Points that a scatter chart of the reports shows (a repeatable sample of that size).
SCATTER_POINTS = {
    "money_scatter": 500,
    "money_scatter_detailed": 1000,
    "profit_scatter": 500,
    "rating_popularity_scatter": 500,
    "performance_points": 500,
}

# All rows behind the scatter charts: x, y and the filter.
SCATTER_AXES = {
    "money_scatter_cells": ("budget_musd", "revenue_musd", BOTH_POSITIVE),
    "profit_scatter_cells": ("budget_musd", "revenue_musd - budget_musd", BOTH_POSITIVE),
    "rating_popularity_cells": ("vote_average", "popularity", "vote_count >= 100"),
    "performance_cells": ("budget_musd", "revenue_musd", f"{BOTH_POSITIVE} and vote_average > 0"),
}


def scatter_cells(df: DataFrame, name: str, bins: int = 50) -> DataFrame:
    """A scatter chart over all rows: how many of its points fall into each cell of a grid."""
    x, y, where = SCATTER_AXES[name]
    return charts.grid_counts(df, x, y, bins, where)


def all_datasets(
    df: DataFrame, years: Sequence[int] | None = None, points: Mapping[str, int] = SCATTER_POINTS
) -> dict[str, DataFrame]:
    """Every chart dataset of fixed size by name.

    ``points`` sizes the samples of the scatter charts; each has a grid of counts over all rows
    beside it. The rating matrix has a column for each of ``years``; without them the ratings
    come as rows of genre and year. The genre charts share one summary, computed here once;
    all other charts scan the stage table for their own columns.
    """
    plain = (
        executive_kpis, rating_histogram, roi_histogram, vote_histogram, revenue_histogram, overview_totals, yearly_revenue,
        yearly_money, budget_tier_share, top_revenue_bars, top_roi_bars, top_popularity_bars, top_rating_bars, top_companies,
        membership_bars, rating_by_genre, yearly_rating_band, genre_roi_bars, roi_by_genre_boxes, revenue_treemap,
        roi_by_tier_boxes, average_roi_by_genre, annotated_top, rating_violin,
    )
    sampled = (money_scatter, money_scatter_detailed, profit_scatter, rating_popularity_scatter, performance_points)
    from_summary = (
        most_frequent_genre, genres_by_revenue, genres_by_count, genre_heatmap, genre_bubbles, genre_evolution,
        genre_sunburst, genre_year_ratings,
    )
    summary = settle(genre_years(df))
    matrix = {} if years is None else {"rating_heatmap": rating_heatmap(df, years, summary)}
    return {
        **{build.__name__: build(df) for build in plain},
        **{build.__name__: build(df, points[build.__name__]) for build in sampled},
        **{name: scatter_cells(df, name) for name in SCATTER_AXES},
        **{build.__name__: build(df, summary=summary) for build in from_summary},
        **matrix,
    }
