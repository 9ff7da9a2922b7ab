"""Chart datasets and batch runs (inventory groups H, P)."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordwise.operators import charts
from recordwise.operators.features import FULL_ORDER
from recordwise.plans import batch, dashboards
from recordwise.sources import storage
from verify.base import averaged, batch_base, case, fresh_path, raw, records, rounded, sql, table, texts
from verify.quality_cases import AS_OF, RANGES, range_sql, rule_sql, RULES, stack, uniqueness_sql
from verify.report_cases import BUD, CAST_DIRECTOR, GENRE_CAST, N, POP, RATE, REV, TOTAL_BUD, TOTAL_REV, grouped
from verify.report_cases import CAST_DIRECTOR_WHERE, GENRE_CAST_WHERE, PARTS, TIERS, COMPANIES

value = sql.value
YEARS = tuple(range(1995, 2002))
BOTH = "budget_musd > 0 and revenue_musd > 0"
GAIN = "(revenue_musd / budget_musd - 1) * 100"
SPREAD = "((id % 2147483648) * 2654435761) % 4294967296, id"
TEXT_OR_WHOLE = {
    "id", "title", "genres", "release_date", "count", "genre", "company", "label", "vote_count", "year", "rank",
}


def chart_case(name, build, statement):
    return case(name, lambda s, d: averaged(texts(build(records(s, d)))), sql.records(statement))


def columns(*names, **computed):
    shown = [n if n in TEXT_OR_WHOLE else f"{value(n)} as {n}" for n in names]
    return ", ".join([*shown, *[f"{value(e)} as {n}" for n, e in computed.items()]])


def sample(shown, where, n, source="records"):
    return f"select {shown} from {source} where {where} order by {SPREAD} limit {n}"


def top(shown, source, by, n, key="id"):
    return f"select {shown} from {source} order by {by} desc nulls last, {key} limit {n}"


def histogram_sql(expr, bins, where="true", source="records"):
    return f"""
    select cast(bin as int) as bin, {value('low')} as bin_start, {value('high')} as bin_end,
      (select count(*) from v where v >= low and (v < high or (bin = {bins - 1} and v <= high))) as count
    from (
      select bin, lo + bin * ((hi - lo) / {bins}) as low,
        case when bin = {bins - 1} then hi else lo + (bin + 1) * ((hi - lo) / {bins}) end as high
      from range({bins}) r(bin), (select min(v) as lo, max(v) as hi from v)
    )""".replace("from v ", f"from (select cast({expr} as double) as v from {source} where {where}) v ").replace(
        "from v)", f"from (select cast({expr} as double) as v from {source} where {where}) v where v is not null)"
    )


def box_sql(keys, expr, source):
    names = {"count": f"count({expr})", "mean": f"avg({expr})", "stddev": f"stddev_samp({expr})", "low": f"min({expr})",
             "q1": f"quantile_cont({expr}, 0.25)", "median": f"quantile_cont({expr}, 0.5)",
             "q3": f"quantile_cont({expr}, 0.75)", "high": f"max({expr})"}
    return sql.select(names, source, keys)


def among_top(source, by, n):
    return f"(select * from {source} where genre in (select genre from {source} group by genre order by {by} desc, genre limit {n}))"


RATED = "(select * from genre where vote_average is not null)"
ROI_GENRE = (
    f"(select * from (select genre, {GAIN} as gain from genre where budget_musd >= 10 and revenue_musd > 0) "
    "where gain between -100 and 500)"
)
ROI_TIER = (
    "(select * from (select case when budget_musd < 10 then 'Low' when budget_musd < 50 then 'Medium' "
    f"when budget_musd < 100 then 'High' else 'Blockbuster' end as budget_tier, {GAIN} as gain from records where {BOTH}) "
    "where gain between -100 and 500)"
)
DATED_GENRE = "(select *, release_year as year from genre)"
HEAT = ("avg_revenue", "avg_budget", "avg_rating", "avg_popularity")
HEAT_TOP = (
    f"(select genre, {REV} as avg_revenue, {BUD} as avg_budget, {RATE} as avg_rating, {POP} as avg_popularity, "
    "count(*) as count from genre group by genre having count(*) >= 5 order by avg_revenue desc, genre limit 12)"
)
SHORT = "=case when length(title) > 20 then substring(title, 1, 20) || '...' else title end"
ROI_BARS = f"(select *, {GAIN} as gain from records where budget_musd >= 10 and revenue_musd > 0)"
GENRE_ROI = (
    f"(select genre, avg({GAIN}) as avg_roi, count(*) as count from genre where budget_musd > 10 and revenue_musd > 0 "
    "group by genre having count(*) >= 5)"
)
COMPANY_TOTALS = (
    f"(select company, {TOTAL_REV} as total_revenue, count(*) as movie_count from {COMPANIES} group by company having count(*) >= 3)"
)
GENRE_TOTALS = f"(select genre, {TOTAL_REV} as total_revenue, count(*) as count from genre group by genre)"
MEMBERS = "(select *, case when has_franchise then 'Franchise' else 'Standalone' end as type from records)"
YEARLY = {"total_revenue": TOTAL_REV, "avg_revenue": REV, "movie_count": N}


def with_missing(spark, folder):
    """Line prices of which some are NULL and some NaN."""
    price = "case l_orderkey % 7 when 0 then null when 1 then double('NaN') else l_extendedprice end as v"
    return table(spark, folder, "lineitem").selectExpr(price)


CHARTS = [
    chart_case("h01_executive_kpis", dashboards.executive_kpis, sql.select(
        {"total_movies": N, "total_revenue": TOTAL_REV, "total_budget": TOTAL_BUD, "avg_rating": RATE,
         "avg_roi": f"avg(case when {BOTH} then {GAIN} end)"}, "records")),
    chart_case("h02_most_frequent_genre", dashboards.most_frequent_genre,
               f"select genre, count from {GENRE_TOTALS} order by count desc, genre limit 1"),
    chart_case("h03_money_scatter", lambda df: dashboards.money_scatter(df, 500),
               sample(columns("id", "budget_musd", "revenue_musd", "vote_average"), BOTH, 500)),
    chart_case("h03_money_scatter_detailed", lambda df: dashboards.money_scatter_detailed(df, 1000), sample(
        columns("id", "title", "budget_musd", "revenue_musd", "vote_average", "genres", "release_date", "profit_musd",
                roi_percent=GAIN), BOTH, 1000)),
    chart_case("h04_genres_by_revenue", dashboards.genres_by_revenue,
               top(columns("genre", "total_revenue", "count"), GENRE_TOTALS, "total_revenue", 10, "genre")),
    chart_case("h04_top_genres_by_count", lambda df: dashboards.genres_by_count(df, 3),
               top(columns("genre", "count"), GENRE_TOTALS, "count", 3, "genre")),
    chart_case("h05_rating_histogram", dashboards.rating_histogram, histogram_sql("vote_average", 20)),
    chart_case("h05_roi_histogram", dashboards.roi_histogram,
               histogram_sql(GAIN, 30, f"{BOTH} and {GAIN} between -100 and 500")),
    chart_case("h05_vote_histogram", dashboards.vote_histogram, histogram_sql("vote_count", 50, "vote_count > 0")),
    chart_case("h05_revenue_histogram", dashboards.revenue_histogram, histogram_sql("revenue_musd", 50, "revenue_musd > 0")),
    case("h05_line_price_histogram",
         lambda s, d: averaged(charts.histogram(table(s, d, "lineitem"), "l_extendedprice", 40)),
         histogram_sql("l_extendedprice", 40, source="lineitem")),
    case("h05_histogram_with_missing",
         lambda s, d: averaged(charts.histogram(with_missing(s, d), "v", 40)),
         histogram_sql("l_extendedprice", 40, source="lineitem where l_orderkey % 7 not in (0, 1)").replace(" where true", " and true")),
    case("h05_histogram_unplaced", lambda s, d: charts.unplaced(with_missing(s, d), "v"),
         "select count(*) as rows, count(*) filter (where l_orderkey % 7 = 0) as nulls, "
         "count(*) filter (where l_orderkey % 7 = 1) as nans from lineitem"),
    chart_case("h06_overview_totals", dashboards.overview_totals, sql.select(
        {"total_movies": N, "total_revenue": TOTAL_REV, "avg_revenue": REV, "total_budget": TOTAL_BUD, "avg_rating": RATE,
         "languages": "count(distinct original_language)", "directors": "count(distinct director)"}, "records")),
    chart_case("h07_yearly_revenue", dashboards.yearly_revenue, grouped(PARTS, ["year"], **YEARLY)),
    chart_case("h07_yearly_revenue_known", lambda df: dashboards.yearly_revenue(df, known_years_only=True),
               grouped(f"{PARTS} where year is not null", ["year"], **YEARLY)),
    chart_case("h07_yearly_money", dashboards.yearly_money,
               grouped("records where release_year is not null", ["release_year"], total_revenue=TOTAL_REV, total_budget=TOTAL_BUD)),
    chart_case("h08_budget_tier_share", dashboards.budget_tier_share,
               grouped(TIERS, ["budget_tier"], count=N, percent="100e0 * count(*) / (select count(*) from records)")),
    chart_case("h09_top_revenue", dashboards.top_revenue_bars,
               top(columns("title", "revenue_musd", "vote_average", "id", label=SHORT), "records", "records.revenue_musd", 10)),
    chart_case("h09_top_roi", dashboards.top_roi_bars,
               top(columns("title", "id", roi="gain", label=SHORT), ROI_BARS, "gain", 10)),
    chart_case("h09_top_popularity", dashboards.top_popularity_bars,
               top(columns("title", "popularity", "id", label=SHORT), "records", "records.popularity", 10)),
    chart_case("h09_top_rating", dashboards.top_rating_bars,
               top(columns("title", "vote_average", "vote_count", "id", label=SHORT), "records where vote_count >= 100",
                   "records.vote_average", 10)),
    chart_case("h10_profit_scatter", lambda df: dashboards.profit_scatter(df, 500),
               sample(columns("id", "budget_musd", profit="profit_musd"), BOTH, 500)),
    chart_case("h11_top_companies", dashboards.top_companies,
               top(columns("company", "total_revenue", movie_count="=movie_count", label="=company"), f"{COMPANY_TOTALS} t",
                   "t.total_revenue", 10, "company")),
    chart_case("h12_membership_bars", dashboards.membership_bars,
               grouped(MEMBERS, ["type"], avg_revenue=REV, avg_budget=BUD, count=N)),
    chart_case("h13_rating_popularity", lambda df: dashboards.rating_popularity_scatter(df, 500),
               sample(columns("id", "vote_average", "popularity", "vote_count"), "vote_count >= 100", 500)),
    chart_case("h14_rating_by_genre", lambda df: dashboards.rating_by_genre(df, 4),
               box_sql(("genre",), "vote_average", among_top(RATED, "count(*)", 4))),
    chart_case("h15_yearly_rating_band", dashboards.yearly_rating_band, grouped(
        PARTS, ["year"], avg_rating=RATE, std_rating="stddev_samp(vote_average)",
        lower=f"{RATE} - stddev_samp(vote_average)", upper=f"{RATE} + stddev_samp(vote_average)")),
    chart_case("h16_genre_heatmap", dashboards.genre_heatmap,
               f"select {columns('genre', 'count', *HEAT)}, "
               + ", ".join(f"{value(f'({c} - (select min({c}) from h)) / nullif((select max({c}) - min({c}) from h), 0)')} as {c}_scaled"
                           for c in HEAT).replace("from h", f"from {HEAT_TOP} h")
               + f" from {HEAT_TOP}"),
    chart_case("h17_genre_roi", dashboards.genre_roi_bars,
               top(columns("genre", "avg_roi", "count",
                           band="=case when avg_roi > 100 then 'green' when avg_roi > 0 then 'orange' else 'red' end"),
                   f"{GENRE_ROI} t", "t.avg_roi", 10, "genre")),
    chart_case("h18_genre_bubbles", dashboards.genre_bubbles,
               grouped("genre", ["genre"], "count(*) >= 5", avg_revenue=REV, avg_rating=RATE, count=N)),
    chart_case("h19_genre_evolution", dashboards.genre_evolution,
               grouped(among_top(DATED_GENRE, "sum(revenue_musd)", 5), ["genre", "year"], revenue=TOTAL_REV)),
    chart_case("h20_genre_sunburst", dashboards.genre_sunburst, grouped("genre", ["genre"], total_revenue=TOTAL_REV, count=N)),
    chart_case("h21_roi_by_genre_boxes", lambda df: dashboards.roi_by_genre_boxes(df, 4),
               box_sql(("genre",), "gain", among_top(ROI_GENRE, "count(*)", 4))),
    chart_case("h22_performance_points", lambda df: dashboards.performance_points(df, 500), sample(
        columns("id", "title", "budget_musd", "revenue_musd", "vote_average", "popularity", "genres"),
        f"{BOTH} and vote_average > 0", 500)),
    chart_case("h23_revenue_treemap", dashboards.revenue_treemap,
               top(columns("id", "title", "revenue_musd", "genres", "vote_average", primary_genre="=string_split(genres, '|')[1]"),
                   "records", "records.revenue_musd", 50)),
    chart_case("h24_rating_heatmap", lambda df: dashboards.rating_heatmap(df, YEARS),
               grouped("genre", ["genre"], **{f"y{y}": f"avg(case when release_year = {y} then vote_average end)" for y in YEARS})),
    chart_case("h24_genre_years", dashboards.genre_year_ratings,
               grouped(DATED_GENRE, ["genre", "year"], avg_rating=RATE)),
    *[chart_case(f"{number}_{name}", lambda df, name=name: dashboards.scatter_cells(df, name, 20).agg(F.sum("count").alias("rows")),
                 f"select cast(count(*) as bigint) as rows from records where {where}")
      for number, name, where in (("h03", "money_scatter_cells", BOTH), ("h10", "profit_scatter_cells", BOTH),
                                  ("h13", "rating_popularity_cells", "vote_count >= 100 and vote_average is not null and popularity is not null"),
                                  ("h22", "performance_cells", f"{BOTH} and vote_average > 0"))],
    chart_case("h25_roi_by_tier_boxes", dashboards.roi_by_tier_boxes, box_sql(("budget_tier",), "gain", ROI_TIER)),
    chart_case("h26_average_roi_by_genre", dashboards.average_roi_by_genre,
               grouped("genre where roi is not null and genre <> ''", ["genre"], avg_roi="avg(roi)")),
    chart_case("h27_annotated_top", dashboards.annotated_top,
               top(columns("id", "title", "budget_musd", "revenue_musd"),
                   "records where budget_musd is not null and revenue_musd is not null", "records.revenue_musd", 3)),
    chart_case("h28_rating_violin", dashboards.rating_violin, box_sql((), "vote_average", "records")),
    chart_case("h29_money_pairs", dashboards.money_pairs,
               f"select {columns('id', 'title', 'budget_musd', 'revenue_musd')} from records "
               "where budget_musd is not null and revenue_musd is not null"),
    chart_case("h29_popularity_pairs", dashboards.popularity_pairs,
               f"select {columns('id', 'popularity', 'vote_average')} from records "
               "where popularity is not null and vote_average is not null"),
    case("h21_line_price_boxes",
         lambda s, d: averaged(charts.box_stats(table(s, d, "lineitem"), ["l_returnflag"], "l_extendedprice")),
         box_sql(("l_returnflag",), "l_extendedprice", "lineitem")),
]

# --- P: batch runs ---------------------------------------------------------------------------

CONFIG = batch.RunConfig(
    as_of=AS_OF, years=YEARS, ranges=RANGES, genre_cast_search=GENRE_CAST, cast_director_search=CAST_DIRECTOR
)
RUN = "run-1"


def finished_run(spark, folder):
    """Base folder of one complete run over the raw records."""
    return batch_base(spark, folder, lambda base: batch.run_batch(spark, raw(spark, folder), base, RUN, CONFIG))


SETTINGS = {
    "processing": {"replacements": {"placeholder_values": ["No Data", "N/A"]}, "quality": {"min_votes_for_rating": 5}},
    "kpis": {"franchise": {"metrics": ["revenue_musd"], "aggregations": ["sum", "median"]},
             "rankings": {"top_n": 4, "metrics": [{"name": "best", "column": "vote_average"}]}},
    "output": {"partitioning": {"columns": ["decade"]}, "formats": ["parquet", "json"]},
    "visualization": {"charts": [
        {"type": "bar", "title": "By kind", "x": "has_franchise", "y": ["revenue_musd", "roi"], "aggregation": "mean"},
        {"type": "box", "title": "Rating by genre", "x": "genres", "y": "vote_average"},
        {"type": "scatter", "title": "Money", "x": "budget_musd", "y": "revenue_musd", "color": "profit_musd", "points": 60},
        {"type": "scatter", "title": "All votes", "x": "vote_average", "y": "popularity", "size": "vote_count"},
    ]},
    "monitoring": {"enabled": True, "metrics": ["record_count", "messages_lost"]},
}


def settings_run(spark, folder):
    """A run with settings of its own: placeholders, matrix, ranking floor, partitions, formats and charts reach its tables."""
    base, config = fresh_path(spark, "settings"), batch.RunConfig.from_dict(SETTINGS)
    outcome = batch.run_batch(spark, raw(spark, folder), base, RUN, config)
    failed = [r["note"] for r in outcome.where("metric = 'succeeded' and value = 0").collect()]
    if failed:
        raise RuntimeError(failed)
    at = lambda *p: spark.read.parquet("/".join([base, p[0], f"run_id={RUN}", *p[1:]]))
    known = spark.read.json(f"{base}/json/run_id={RUN}/features").agg(F.count("tagline").cast("double").alias("value"))
    parts = [
        known.select(F.lit("taglines").alias("kind"), F.lit("").alias("name"), "value"),
        at("kpis", "franchise_matrix").select(F.lit("median"), "belongs_to_collection", "revenue_musd_median"),
        at("kpis", "rankings", "best").select(F.lit("best"), F.col("id").cast("string"), "vote_average"),
        at("charts", "declared_by_kind").select(F.lit("bar"), F.col("has_franchise").cast("string"), "revenue_musd_mean"),
        at("charts", "declared_rating_by_genre").select(F.lit("box"), "genres", "median"),
        at("charts", "declared_money").select(F.lit("point"), F.col("id").cast("string"), "profit_musd"),
        at("charts", "declared_money_cells").agg(F.lit("cells"), F.lit("money"), F.sum("count").cast("double")),
        at("charts", "declared_all_votes").agg(F.lit("points"), F.lit("votes"), F.count("id").cast("double")),
        at("charts", "declared_all_votes_cells").agg(F.lit("cells"), F.lit("votes"), F.sum("count").cast("double")),
        batch.monitored_metrics(spark, base, RUN, config).select(F.lit("monitored"), F.concat_ws(" ", "stage", "metric", "note"), "value"),
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.union(part)
    return averaged(result)


KNOWN_TAGLINES = "count(nullif(tagline, 'N/A')) * 1.0"
KNOWN_MONEY = "budget_musd is not null and revenue_musd is not null"
COUNTS = {"ingest": "select count(*) from raw", "clean": "select count(*) from cleaned", "features": "select count(*) from records"}

SETTINGS_SQL = (
    f"select 'taglines' as kind, '' as name, {value(KNOWN_TAGLINES)} as value from records "
    f"union all select 'median', belongs_to_collection, {value('median(revenue_musd)')} from records where has_franchise group by belongs_to_collection "
    f"union all (select 'best', cast(id as varchar), {value('vote_average')} from records where vote_count >= 5 order by records.vote_average desc nulls last, id limit 4) "
    f"union all select 'bar', cast(has_franchise as varchar), {value('avg(revenue_musd)')} from records group by has_franchise "
    f"union all select 'box', genre, {value('median(vote_average)')} from genre where vote_average is not null group by genre "
    f"union all select 'point', cast(id as varchar), {value('profit_musd')} from ({sample('id, profit_musd', KNOWN_MONEY, 60)}) "
    f"union all select 'cells', 'money', count(*) * 1.0 from records where {KNOWN_MONEY} "
    f"union all select kind, 'votes', count(*) * 1.0 from records, (values ('points'), ('cells')) k(kind) "
    "where vote_average is not null and popularity is not null group by kind "
    + "".join(f"union all select 'monitored', '{stage} record_count', ({query}) * 1.0 " for stage, query in COUNTS.items())
    + "union all select 'monitored', 'monitoring messages_lost not measured', null"
)


def run_records(spark, folder):
    return storage.read_run_records(spark, finished_run(spark, folder)).where(F.col("run_id") == RUN)


def batch_run(spark, folder):
    facts = run_records(spark, folder).where("metric not in ('execution_time', 'data_quality_score', 'healthy', 'null_percentage')")
    return facts.select("stage", "metric", "value", "note")


def stage_counts(spark, folder):
    """Rows of each stage table as they stand on storage."""
    base = finished_run(spark, folder)
    return storage.row_counts({s: storage.read_stage(spark, base, s, RUN) for s in (batch.CLEANED, batch.FEATURES)})


def monitored(spark, folder):
    wanted = run_records(spark, folder).where("metric in ('execution_time', 'data_quality_score', 'record_count', 'null_percentage')")
    timed = F.when(F.col("metric") == "execution_time", (F.col("value") >= 0).cast("double"))
    return rounded(wanted.select("run_id", "stage", "metric", F.coalesce(timed, "value").alias("value")))


def fact(stage, metric, query):
    return f"select '{stage}' as stage, '{metric}' as metric, cast(({query}) as double) as value, cast(null as varchar) as note"


STAGES = ("ingest", "clean", "features", "quality", "kpis", "metrics", "searches", "charts")
FACTS = [
    *[fact(s, "record_count", q) for s, q in COUNTS.items()],
    *[fact(s, "succeeded", "select 1") for s in STAGES],
    fact("kpis", "tables", "select 19"), fact("metrics", "tables", "select 10"), fact("metrics", "failed_tables", "select 0"),
    fact("charts", "tables", "select 42"),
    fact("searches", "genre_cast_found", f"select count(*) from records where {GENRE_CAST_WHERE}"),
    fact("searches", "cast_director_found", f"select count(*) from records where {CAST_DIRECTOR_WHERE}"),
]
GATED = stack([p for c, r in RANGES.items() for p in range_sql(c, r["min"], r["max"], "records")],
              [rule_sql(n, "records") for n in RULES], uniqueness_sql(["id"], "records"))
SCORE = (
    "select round(sum(ok) * 100 / count(*), 2) from (select \"check\", \"column\", cast(bool_and(is_valid) as int) as ok "
    f"from ({GATED}) group by 1, 2)"
)
NEVER_NULL = {"cast", "has_franchise", "budget_category", "rating_category"}
NULL_SHARE = "select 100 - (" + " + ".join(
    "100" if c in NEVER_NULL else "0" if c == "backdrop_path" else f"round(count({c}) * 100 / count(*), 2)" for c in FULL_ORDER
) + f" + 100) / {len(FULL_ORDER) + 1} from records"
MONITORED = " union all ".join(
    f"select '{RUN}' as run_id, stage, metric, value from ({part})"
    for part in [
        *[fact(s, "execution_time", "select 1") for s in STAGES],
        *[fact(s, "record_count", q) for s, q in COUNTS.items()],
        fact("quality", "data_quality_score", SCORE),
        fact("quality", "null_percentage", f"select round(x, 6) from ({NULL_SHARE}) t(x)"),
    ]
)

RUNS = [
    case("p01_batch_run", batch_run, sql.records(" union all ".join(FACTS))),
    case("p01_settings_run", settings_run, sql.records(SETTINGS_SQL)),
    case("p02_stage_record_counts", stage_counts, sql.records(
        "select 'cleaned' as name, count(*) as rows from cleaned union all select 'features', count(*) from records")),
    case("p03_run_records",
         lambda s, d: run_records(s, d).where("metric = 'record_count'").select("run_id", "attempt", "stage", "value"),
         sql.records(" union all ".join(
             f"select '{RUN}' as run_id, cast(1 as int) as attempt, stage, value from ({fact(s, 'record_count', q)})" for s, q in COUNTS.items()))),
    case("p04_monitored_metrics", monitored, sql.records(MONITORED)),
]

CASES = [*CHARTS, *RUNS]
