"""Rankings, searches and grouped reports (inventory groups E, F, G)."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordwise.functions.values import ordinal
from recordwise.operators import grouping, ranking
from recordwise.operators.features import BUDGET_LABELS
from recordwise.plans import kpis, metrics, searches
from recordwise.plans.rankings import RANKINGS
from verify.base import OFFSET, averaged, case, records, rounded, sql, table, texts

# --- E: rankings ----------------------------------------------------------------------------

BASE = ("rank", "id", "title", "release_year")
METRICS = ("budget_musd", "revenue_musd", "vote_average", "vote_count")
WHOLE = ("vote_count",)


def ranked_sql(spec, nulls=None):
    column = spec["column"]
    up = spec.get("ascending", False)
    nulls = nulls or ("first" if up else "last")
    order = f"{column} {'asc' if up else 'desc'} nulls {nulls}, id"
    shown = [*([] if column in METRICS else [column]), *METRICS]
    values = ", ".join(c if c in WHOLE else f"round({c}, 6) as {c}" for c in shown)
    return (
        f"select cast(row_number() over (order by {order}) as int) as rank, id, title, release_year, {values} "
        f"from records where {spec.get('filter', 'true')} order by rank limit 10"
    )


def ranking_case(number, spec):
    def build(spark, folder):
        return rounded(
            ranking.rank_report(records(spark, folder), spec["column"], spec.get("ascending", False), spec.get("filter"))
        )

    return case(f"e{number:02d}_{spec['name']}", build, sql.records(ranked_sql(spec)))


def long_sql():
    parts = []
    for spec in RANKINGS:
        up = spec.get("ascending", False)
        order = f"{spec['column']} {'asc nulls first' if up else 'desc nulls last'}, id"
        parts.append(
            f"(select '{spec['name']}' as metric, cast(row_number() over (order by {order}) as int) as rank, id, title, "
            f"round(cast({spec['column']} as double), 6) as value from records where {spec.get('filter', 'true')} "
            f"order by rank limit 10)"
        )
    return " union all ".join(parts)


def by_category_order(spark, folder):
    counted = grouping.group_metrics(records(spark, folder), ["budget_category"], {"count": "count(1)"})
    return counted.withColumn("place", ordinal("budget_category", BUDGET_LABELS)).orderBy("place")


LOWEST_ROI = next(spec for spec in RANKINGS if spec["name"] == "lowest_roi")

RANKING_CASES = [
    case("e01_top_lines_by_price",
         lambda s, d: rounded(ranking.top_n(
             table(s, d, "lineitem").withColumn("line_key", F.concat_ws("/", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")),
             "l_extendedprice", 25, where="l_discount >= 0.05", key="line_key",
             columns=["line_key", "l_extendedprice", "l_quantity"], rank="rank")),
         "select cast(row_number() over (order by l_extendedprice desc nulls last, line_key) as int) as rank, line_key, "
         "round(l_extendedprice, 6) as l_extendedprice, round(l_quantity, 6) as l_quantity from (select *, l_orderkey || '/' || "
         "l_linenumber || '/' || l_partkey || '/' || l_suppkey as line_key from lineitem where l_discount >= 0.05) order by rank limit 25"),
    *[ranking_case(i, spec) for i, spec in enumerate(RANKINGS, start=2)],
    case("e07_lowest_roi_nulls_last",
         lambda s, d: rounded(ranking.rank_report(records(s, d), "roi", True, "budget_musd >= 10", nulls="last")),
         sql.records(ranked_sql(LOWEST_ROI, nulls="last"))),
    case("e12_all_rankings", lambda s, d: rounded(ranking.rank_long(records(s, d), RANKINGS)), sql.records(long_sql())),
    case("e13_category_order", by_category_order, sql.records(
        "select budget_category, cast(count(*) as bigint) as count, cast(case budget_category when 'Micro' then 1 when 'Low' then 2 "
        "when 'Medium' then 3 when 'High' then 4 else 5 end as int) as place from records group by budget_category")),
]

# --- F: searches ----------------------------------------------------------------------------

GENRE_CAST = {"genres": ("STANDARD", "PROMO"), "cast": "Supplier#000000001"}
CAST_DIRECTOR = {"cast": "Supplier#000000021", "director": "Supplier#000000021"}


def has(column, value):
    return f"list_contains(string_split({column}, '|'), '{value}')"


def in_people(value):
    return f"list_contains(people, '{value}')"


def shown(columns):
    whole = {"id", "title", "release_year", "genres", "vote_count", "director", "runtime", "tagline", "popularity"}
    return ", ".join(
        'cast_text as "cast"' if c == "cast" else c if c in whole else f"round({c}, 6) as {c}" for c in columns
    )


GENRE_CAST_WHERE = f"{has('genres', 'STANDARD')} and {has('genres', 'PROMO')} and {in_people('Supplier#000000001')}"
CAST_DIRECTOR_WHERE = f"{in_people('Supplier#000000021')} and director = 'Supplier#000000021'"
FOUND = ("id", "title", "vote_average", "runtime")


def found(df):
    return rounded(df.select(*FOUND))


FOUND_SQL = "id, title, round(vote_average, 6) as vote_average, runtime"


def with_cast_text(spark, folder):
    return records(spark, folder).withColumn("cast", F.array_join("cast", "|"))


def both(name):
    def build(spark, folder):
        results = searches.both_searches(records(spark, folder), GENRE_CAST, CAST_DIRECTOR)
        return found(results[name])

    return build


SEARCH_CASES = [
    case("f01_genres_and_cast_text",
         lambda s, d: found(searches.by_genres_and_cast(
             with_cast_text(s, d), ["STANDARD", "PROMO"], "Supplier#00000000", match="substring")),
         sql.records(f"select {FOUND_SQL} from records where contains(genres, 'STANDARD') and contains(genres, 'PROMO') "
                     "and contains(cast_text, 'Supplier#00000000')")),
    case("f01_genres_and_cast_exact",
         lambda s, d: found(searches.by_genres_and_cast(with_cast_text(s, d), ["STANDARD", "PROMO"], "Supplier#000000001")),
         sql.records(f"select {FOUND_SQL} from records where {GENRE_CAST_WHERE}")),
    case("f02_cast_and_director",
         lambda s, d: found(searches.by_cast_and_director(with_cast_text(s, d), **CAST_DIRECTOR)),
         sql.records(f"select {FOUND_SQL} from records where {CAST_DIRECTOR_WHERE}")),
    case("f03_genre_cast_search",
         lambda s, d: rounded(texts(searches.genre_cast_search(records(s, d), GENRE_CAST))),
         sql.records(f"select {shown(searches.GENRE_CAST_COLUMNS)} from records where {GENRE_CAST_WHERE}")),
    case("f04_cast_director_search",
         lambda s, d: rounded(texts(searches.cast_director_search(records(s, d), CAST_DIRECTOR))),
         sql.records(f"select {shown(searches.CAST_DIRECTOR_COLUMNS)} from records where {CAST_DIRECTOR_WHERE}")),
    case("f02_cast_and_director_text",
         lambda s, d: found(searches.by_cast_and_director(with_cast_text(s, d), "#00000002", "Supplier#000000021", match="substring")),
         sql.records(f"select {FOUND_SQL} from records where contains(cast_text, '#00000002') and director = 'Supplier#000000021'")),
    case("f03_genre_cast_search_text",
         lambda s, d: rounded(texts(searches.genre_cast_search(
             with_cast_text(s, d), {"genres": ("STAND", "PROM"), "cast": "Supplier#00000000"}, match="substring"))),
         sql.records(f"select {shown(searches.GENRE_CAST_COLUMNS)} from records where contains(genres, 'STAND') "
                     "and contains(genres, 'PROM') and contains(cast_text, 'Supplier#00000000')")),
    case("f04_cast_director_search_text",
         lambda s, d: rounded(texts(searches.cast_director_search(
             with_cast_text(s, d), {"cast": "#00000002", "director": "Supplier#000000021"}, match="substring"))),
         sql.records(f"select {shown(searches.CAST_DIRECTOR_COLUMNS)} from records where contains(cast_text, '#00000002') "
                     "and director = 'Supplier#000000021'")),
    case("f07_best_roi_in_genre_text",
         lambda s, d: rounded(searches.best_roi_in_genre(records(s, d), "PROM", 10, 5.0, "substring").select("id", "roi", "budget_musd")),
         sql.records("select id, round(roi, 6) as roi, round(budget_musd, 6) as budget_musd from records where contains(genres, 'PROM') "
                     "and budget_musd >= 5 and roi is not null order by records.roi desc, id limit 10")),
    case("f05_by_years", lambda s, d: found(searches.by_years(records(s, d), 1996, 1998, 6.0)),
         sql.records(f"select {FOUND_SQL} from records where release_year between 1996 and 1998 and vote_average >= 6.0")),
    case("f06_by_budget", lambda s, d: found(searches.by_budget(records(s, d), 20, 60)),
         sql.records(f"select {FOUND_SQL} from records where budget_musd between 20 and 60")),
    case("f07_best_roi_in_genre",
         lambda s, d: rounded(searches.best_roi_in_genre(records(s, d), "PROMO", 10, 5.0).select("id", "roi", "budget_musd")),
         sql.records(f"select id, round(roi, 6) as roi, round(budget_musd, 6) as budget_musd from records where {has('genres', 'PROMO')} "
                     "and budget_musd >= 5 and roi is not null order by records.roi desc, id limit 10")),
    case("f08_array_genre_cast", both("genre_cast"),
         sql.records(f"select {FOUND_SQL} from records where {GENRE_CAST_WHERE}")),
    case("f08_array_cast_director", both("cast_director"),
         sql.records(f"select {FOUND_SQL} from records where {CAST_DIRECTOR_WHERE}")),
]

# --- G: grouped reports ---------------------------------------------------------------------

N = "count(*)"
REV, BUD, RATE, POP = "avg(revenue_musd)", "avg(budget_musd)", "avg(vote_average)", "avg(popularity)"
TOTAL_REV, TOTAL_BUD = "sum(revenue_musd)", "sum(budget_musd)"
VOTES = "=cast(sum(vote_count) as bigint)"
SPAN = {"first_release": "=min(release_date)", "latest_release": "=max(release_date)"}


def grouped(source, keys, having=None, **columns):
    return sql.select(columns, source, tuple(keys), f"having {having}" if having else "")


def report_case(name, build, statement, whole=sql.records):
    comparable = averaged if str(OFFSET) in statement else rounded
    return case(name, lambda s, d: comparable(texts(build(records(s, d)))), whole(statement))


SUMMARY_SQL = sql.select(
    {
        "total_movies": N, "total_revenue": TOTAL_REV, "total_budget": TOTAL_BUD, "total_profit": "sum(profit_musd)",
        "avg_revenue": REV, "median_revenue": "median(revenue_musd)", "avg_budget": BUD, "avg_roi": "avg(roi)",
        "avg_rating": RATE, "avg_popularity": POP, "max_revenue": "max(revenue_musd)", "min_revenue": "min(revenue_musd)",
        "unique_directors": "count(distinct director)", "franchise_movies": "count(*) filter (where has_franchise)",
    },
    "records",
)


def section(name, metric, value):
    return f"select '{name}' as section, '{metric}' as metric, round(cast(round({value}, 8) as double), 2) as value from records"


SECTIONS_SQL = " union all ".join([
    section("overview", "total_movies", "count(*)"), section("overview", "unique_directors", "count(distinct director)"),
    section("overview", "unique_languages", "count(distinct original_language)"),
    section("financial", "total_revenue_musd", TOTAL_REV), section("financial", "avg_revenue_musd", REV),
    section("financial", "min_revenue_musd", "min(revenue_musd)"), section("financial", "max_revenue_musd", "max(revenue_musd)"),
    section("financial", "avg_budget_musd", BUD), section("quality", "avg_rating", RATE),
    section("quality", "avg_popularity", POP), section("quality", "avg_runtime_min", "avg(runtime)"),
])

CORR_ROWS = "from records where budget_musd is not null and revenue_musd is not null"


def correlation_sql(zero=False):
    def side(c):
        return f"coalesce({c}, 0)" if zero else c

    return " union all ".join(
        f"select '{pair}' as pair, round(corr({side(a)}, {side(b)}), 6) as correlation {CORR_ROWS}"
        for pair, (a, b) in metrics.CORRELATED.items()
    )


TEMPORAL = {
    "movie_count": N, "total_revenue": TOTAL_REV, "avg_revenue": REV, "total_budget": TOTAL_BUD, "avg_budget": BUD,
    "avg_rating": RATE, "avg_popularity": POP, "avg_runtime": "avg(runtime)",
}
PARTS = (
    "(select *, cast(year(try_cast(release_date as date)) as int) as year, "
    "cast(quarter(try_cast(release_date as date)) as int) as quarter, "
    "cast(month(try_cast(release_date as date)) as int) as month from records)"
)
TIERS = (
    "(select *, case when budget_musd < 10 then 'Low (<$10M)' when budget_musd < 50 then 'Medium ($10M-$50M)' "
    "when budget_musd < 100 then 'High ($50M-$100M)' else 'Blockbuster (>$100M)' end as budget_tier, "
    "case when vote_average < 5 then 'Poor (<5.0)' when vote_average < 7 then 'Average (5.0-7.0)' "
    "when vote_average < 8 then 'Good (7.0-8.0)' else 'Excellent (>8.0)' end as rating_tier from records)"
)
COMPANIES = "(select *, unnest(string_split(production_companies, '|')) as company from records where production_companies is not null)"
ACTORS = "(select *, unnest(people) as actor from records)"
MATRIX = {
    f"{c}_{name}": expr.format(c=c)
    for c in kpis.FRANCHISE_MATRIX["columns"]
    for name, expr in {
        "count": "count({c})", "sum": "sum({c})", "mean": "avg({c})", "median": "median({c})", "std": "stddev_samp({c})",
    }.items()
}

GROUP_CASES = [
    report_case("g01_franchise_performance", lambda df: kpis.franchise_performance(df, accuracy=1_000_000),
                grouped("(select *, case when has_franchise then 'Franchise' else 'Standalone' end as is_franchise from records)",
                        ["is_franchise"], mean_revenue=REV, median_roi="quantile_disc(roi, 0.5)", mean_budget=BUD,
                        mean_popularity=POP, mean_rating=RATE, movie_count="count(id)")),
    report_case("g02_successful_franchises", kpis.successful_franchises,
                grouped("records where belongs_to_collection is not null", ["belongs_to_collection"], movie_count="count(id)",
                        total_budget=TOTAL_BUD, mean_budget=BUD, total_revenue=TOTAL_REV, mean_revenue=REV, mean_rating=RATE)),
    report_case("g03_successful_directors", kpis.successful_directors,
                grouped("records where director is not null", ["director"], movie_count="count(id)",
                        total_revenue=TOTAL_REV, mean_rating=RATE)),
    report_case("g04_roi_by_genre", kpis.roi_by_genre,
                "select genre, round(roi, 6) as roi from genre where roi is not null and genre <> ''"),
    report_case("g05_franchise_against_standalone", kpis.franchise_against_standalone,
                grouped("records", ["has_franchise"], movie_count=N, mean_revenue=REV, median_revenue="median(revenue_musd)",
                        mean_roi="avg(roi)", median_roi="median(roi)", mean_budget=BUD, median_budget="median(budget_musd)",
                        mean_popularity=POP, mean_rating=RATE, mean_profit="avg(profit_musd)")),
    report_case("g06_top_franchises", kpis.top_franchises,
                grouped("records where has_franchise", ["belongs_to_collection"], total_movies=N, total_budget=TOTAL_BUD,
                        mean_budget=BUD, total_revenue=TOTAL_REV, mean_revenue=REV, total_profit="sum(profit_musd)",
                        mean_profit="avg(profit_musd)", mean_roi="avg(roi)", mean_rating=RATE, mean_popularity=POP,
                        total_votes=VOTES)),
    report_case("g07_top_directors", lambda df: kpis.top_directors(df, min_movies=10),
                grouped("records where director is not null", ["director"], "count(*) >= 10", total_movies=N,
                        total_revenue=TOTAL_REV, avg_revenue=REV, avg_rating=RATE, total_profit="sum(profit_musd)",
                        avg_profit="avg(profit_musd)", avg_roi="avg(roi)", total_votes=VOTES, avg_budget=BUD)),
    report_case("g08_genre_performance", kpis.genre_performance,
                grouped("genre", ["genre"], movie_count=N, avg_revenue=REV, median_revenue="median(revenue_musd)",
                        avg_roi="avg(roi)", median_roi="median(roi)", avg_budget=BUD, avg_rating=RATE, avg_popularity=POP,
                        total_revenue=TOTAL_REV)),
    report_case("g09_yearly_trends", kpis.yearly_trends,
                grouped("records", ["release_year"], movies_released=N, total_revenue=TOTAL_REV, avg_revenue=REV,
                        total_budget=TOTAL_BUD, avg_budget=BUD, avg_roi="avg(roi)", avg_rating=RATE, avg_popularity=POP)),
    report_case("g10_decade_trends", kpis.decade_trends,
                grouped("records", ["decade"], movies_released=N, total_revenue=TOTAL_REV, avg_revenue=REV, avg_budget=BUD,
                        avg_roi="avg(roi)", avg_rating=RATE)),
    report_case("g11_language_performance", kpis.language_performance,
                grouped("records", ["original_language"], "count(*) >= 2", movie_count=N, avg_revenue=REV, avg_budget=BUD,
                        avg_rating=RATE, total_revenue=TOTAL_REV)),
    report_case("g12_budget_category_performance", kpis.budget_category_performance,
                grouped("records", ["budget_category"], movie_count=N, avg_revenue=REV, avg_roi="avg(roi)", avg_rating=RATE,
                        avg_popularity=POP)),
    report_case("g13_summary_statistics", kpis.summary_statistics, SUMMARY_SQL),
    *[
        report_case(f"g14_kpi_{name}", lambda df, name=name: kpis.all_kpis(df)[name], statement)
        for name, statement in {
            "decade_trends": grouped("records", ["decade"], movies_released=N, total_revenue=TOTAL_REV, avg_revenue=REV,
                                     avg_budget=BUD, avg_roi="avg(roi)", avg_rating=RATE),
            "summary_statistics": SUMMARY_SQL,
        }.items()
    ],
    report_case("g15_temporal_metrics", metrics.temporal_metrics, grouped(PARTS, ["year"], **TEMPORAL)),
    report_case("g15_temporal_metrics_quarter", lambda df: metrics.temporal_metrics(df, "quarter"),
                grouped(PARTS, ["year", "quarter"], **TEMPORAL)),
    report_case("g15_temporal_metrics_month", lambda df: metrics.temporal_metrics(df, "month"),
                grouped(PARTS, ["year", "month"], **TEMPORAL)),
    report_case("g16_genre_metrics", metrics.genre_metrics,
                grouped("genre", ["genre"], movie_count=N, total_revenue=TOTAL_REV, avg_revenue=REV, avg_budget=BUD,
                        avg_rating=RATE, avg_popularity=POP, profitable_count="count(*) filter (where revenue_musd > budget_musd)",
                        profitability_rate="=round(count(*) filter (where revenue_musd > budget_musd) / count(*) * 100, 2)")),
    report_case("g17_language_metrics", metrics.language_metrics,
                grouped("records", ["original_language"], "count(*) >= 5", movie_count=N, total_revenue=TOTAL_REV,
                        avg_revenue=REV, avg_rating=RATE, avg_popularity=POP)),
    report_case("g18_company_metrics", metrics.company_metrics,
                grouped(COMPANIES, ["company"], "count(*) >= 3", movie_count=N, total_revenue=TOTAL_REV, avg_revenue=REV,
                        avg_rating=RATE, max_revenue="max(revenue_musd)", **SPAN)),
    report_case("g19_director_metrics", metrics.director_metrics,
                grouped("records where director is not null", ["director"], "count(*) >= 2", movie_count=N,
                        total_revenue=TOTAL_REV, avg_revenue=REV, avg_rating=RATE, avg_popularity=POP)),
    report_case("g19_director_members", metrics.director_members,
                "select director, id, title from records where director in "
                "(select director from records where director is not null group by director having count(*) >= 2)"),
    report_case("g20_franchise_metrics", metrics.franchise_metrics,
                grouped("records where belongs_to_collection is not null", ["belongs_to_collection"], movie_count=N,
                        total_revenue=TOTAL_REV, avg_revenue=REV, total_budget=TOTAL_BUD, avg_budget=BUD, avg_rating=RATE,
                        total_profit="sum(revenue_musd) - sum(budget_musd)", avg_roi="=round(sum(revenue_musd) / nullif(sum(budget_musd), 0), 2)", **SPAN)),
    report_case("g20_franchise_members", metrics.franchise_members,
                "select belongs_to_collection, id, title from records where belongs_to_collection is not null"),
    report_case("g21_budget_tier_metrics", metrics.budget_tier_metrics,
                grouped(TIERS, ["budget_tier"], movie_count=N, avg_budget=BUD, avg_revenue=REV, avg_rating=RATE,
                        avg_popularity=POP, avg_roi_pct="avg((revenue_musd - budget_musd) / nullif(budget_musd, 0) * 100)")),
    report_case("g22_rating_tier_metrics", metrics.rating_tier_metrics,
                grouped(TIERS, ["rating_tier"], movie_count=N, avg_revenue=REV, avg_budget=BUD, avg_popularity=POP,
                        avg_vote_count="avg(vote_count)")),
    report_case("g23_correlations", metrics.correlation_metrics, correlation_sql()),
    report_case("g23_correlations_zero", lambda df: metrics.correlation_metrics(df, "zero"), correlation_sql(zero=True)),
    report_case("g24_summary_sections", metrics.summary_sections, SECTIONS_SQL),
    report_case("g25_collaborations", searches.collaborations,
                grouped(ACTORS, ["director", "actor"], "count(*) >= 2", movies_together=N, avg_rating=RATE,
                        total_revenue=TOTAL_REV)),
    report_case("g25_collaboration_members", searches.collaboration_members,
                f"select a.director, a.actor, a.id, a.title from {ACTORS} a join (select director, actor from {ACTORS} x "
                "group by director, actor having count(*) >= 2) p on a.actor = p.actor and a.director is not distinct from p.director"),
    report_case("g26_compare_decades", lambda df: searches.compare_decades(df, 1990, 2000),
                grouped("records where decade in (1990, 2000)", ["decade"], movie_count=N, avg_revenue=REV, avg_budget=BUD,
                        avg_roi="avg(roi)", avg_rating=RATE, avg_popularity=POP)),
    report_case("g27_franchise_matrix", kpis.franchise_matrix,
                grouped("records where has_franchise", ["belongs_to_collection"], **MATRIX)),
    case("g27_line_matrix",
         lambda s, d: averaged(grouping.agg_matrix(
             table(s, d, "lineitem"), ["l_returnflag", "l_linestatus"], ["l_quantity", "l_extendedprice"],
             ["count", "sum", "mean", "median", "std", "min", "max"])),
         sql.select({
             f"{c}_{n}": e.format(c=c) for c in ("l_quantity", "l_extendedprice") for n, e in {
                 "count": "count({c})", "sum": "sum({c})", "mean": "avg({c})", "median": "median({c})",
                 "std": "stddev_samp({c})", "min": "min({c})", "max": "max({c})"}.items()},
             "lineitem", ("l_returnflag", "l_linestatus"))),
    case("g15_orders_by_month",
         lambda s, d: averaged(grouping.group_metrics(
             table(s, d, "orders").selectExpr("year(o_orderdate) as year", "month(o_orderdate) as month", "o_totalprice"),
             ["year", "month"], {"orders": "count(1)", "total": "sum(o_totalprice)", "mean": "avg(o_totalprice)"})),
         sql.select({"orders": N, "total": "sum(o_totalprice)", "mean": "avg(o_totalprice)"},
                    "(select cast(year(o_orderdate) as int) as year, cast(month(o_orderdate) as int) as month, o_totalprice from orders)",
                    ("year", "month"))),
    case("g08_words_in_part_names",
         lambda s, d: grouping.group_metrics(
             grouping.explode_values(table(s, d, "part").select("p_name"), "p_name", "word", " "), ["word"], {"parts": "count(1)"}),
         "select word, cast(count(*) as bigint) as parts from (select unnest(string_split(p_name, ' ')) as word from part) group by word"),
]

CASES = [*RANKING_CASES, *SEARCH_CASES, *GROUP_CASES]
