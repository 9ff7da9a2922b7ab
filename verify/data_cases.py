"""Sources, sinks, cleaning and features (inventory groups A, B, C)."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordwise.functions import dates, nested, values
from recordwise.operators import cleaning, features
from recordwise.plans import kpis, metrics
from recordwise.plans.rankings import all_rankings
from recordwise.sources import records as record_sources
from recordwise.sources import storage
from verify.order_records import (
    LINE_ORDER,
    nested_credits,
    order_credit_rows,
    order_details,
)
from verify.base import case, cleaned, fresh_path, raw, records, rounded, sql, table, texts

RAW_FACTS = ("id", "title", "status", "budget", "revenue", "runtime", "vote_average", "vote_count", "director")
RAW_FACTS_SQL = ", ".join(c if c != "vote_average" else "round(vote_average, 6) as vote_average" for c in RAW_FACTS)


# --- A: sources and sinks -----------------------------------------------------------------


def raw_round_trip(fmt):
    def build(spark, folder):
        paths = storage.write_raw(raw(spark, folder), fresh_path(spark, "round-trip"), "r1")
        back = record_sources.read_records(spark, paths[fmt], fmt)
        return rounded(cleaning.join_names(back, {"genres": "name"}).select(*RAW_FACTS, "genres"))

    return build


def credits_from_rows(spark, folder):
    credits = order_credit_rows(spark, folder)
    full = record_sources.attach_credit_rows(order_details(spark, folder), credits, credits, LINE_ORDER)
    return texts(full.select("id", "cast", "cast_size", "director", "crew_size"))


def credits_from_arrays(spark, folder):
    details = table(spark, folder, "orders").select(F.col("o_orderkey").alias("id"))
    full = record_sources.attach_credits(details, nested_credits(spark, folder))
    return texts(full.select("id", "cast", "cast_size", "director", "crew_size"))


def wanted_ids(spark, folder):
    """Thirteen times each customer key: some are order keys, some are not."""
    return table(spark, folder, "customer").select((F.col("c_custkey") * 13).alias("id"))


def stage_hand_over(spark, folder):
    base = fresh_path(spark, "stages")
    storage.write_stage(cleaned(spark, folder), base, "cleaned", "2024-01-01")
    back = storage.read_stage(spark, base, "cleaned", "2024-01-01")
    return back.select("id", "title", "budget", "genres", "release_date")


def repeated_empty(spark, folder):
    """Two runs of a stage, the second repeated with no rows: only the first run's rows are left."""
    base, rows = fresh_path(spark, "stages"), cleaned(spark, folder).select("id", "title")
    for run, part in (("1", rows), ("2", rows), ("2", rows.limit(0))):
        storage.write_stage(part, base, "cleaned", run)
    runs = [storage.read_stage(spark, base, "cleaned", run).withColumn("run", F.lit(run)) for run in ("1", "2")]
    return runs[0].unionByName(runs[1])


def repeated_run(spark, folder):
    """A run written with all years, then again with some: what was written last stays."""
    base, rows = fresh_path(spark, "partitioned"), records(spark, folder).select("id", "title", "release_year")
    storage.write_stage(rows, base, "features", "run1", ("release_year",))
    storage.write_stage(rows.where("release_year between 1995 and 1996"), base, "features", "run1", ("release_year",))
    return storage.read_stage(spark, base, "features", "run1")


def csv_report(spark, folder):
    path = fresh_path(spark, "csv")
    report = all_rankings(records(spark, folder))["highest_revenue"]
    storage.write_csv(report, path, single_file=True)
    back = spark.read.option("header", True).csv(path)
    return rounded(back.select(F.col("rank").cast("int"), F.col("id").cast("long"), "title", F.col("revenue_musd").cast("double")))


def saved_results(spark, folder):
    """Two KPI tables and a ranking, saved and read back whole."""
    results = kpis.all_kpis(records(spark, folder))
    base = fresh_path(spark, "kpis")
    storage.save_results(spark, results, base)
    language = spark.read.parquet(f"{base}/language_performance").select(F.col("original_language").alias("name"), F.col("total_revenue").alias("value"))
    years = spark.read.parquet(f"{base}/yearly_trends").select(F.col("release_year").cast("string").alias("name"), F.col("total_revenue").alias("value"))
    top = spark.read.parquet(f"{base}/rankings/highest_revenue").select(F.col("id").cast("string").alias("name"), F.col("revenue_musd").alias("value"))
    parts = {"language": language, "year": years, "ranking": top}
    tagged = [frame.withColumn("kind", F.lit(kind)) for kind, frame in parts.items()]
    return rounded(tagged[0].unionByName(tagged[1]).unionByName(tagged[2]))


SAVED_SQL = (
    "select 'language' as kind, original_language as name, round(sum(revenue_musd), 6) as value from records "
    "group by original_language having count(*) >= 2 "
    "union all select 'year', cast(release_year as varchar), round(sum(revenue_musd), 6) from records group by release_year "
    "union all (select 'ranking', cast(id as varchar), round(revenue_musd, 6) from records order by revenue_musd desc nulls last, id limit 10)"
)


SAVED_COUNTS = {
    "franchise_comparison": "select count(distinct has_franchise) from records",
    "top_franchises": "select count(distinct belongs_to_collection) from records",
    "top_directors": "select count(distinct director) from records",
    "genre_performance": "select count(distinct genre) from genre",
    "yearly_trends": "select count(*) from (select distinct release_year from records)",
    "decade_trends": "select count(*) from (select distinct decade from records)",
    "language_performance": "select count(*) from (select 1 from records group by original_language having count(*) >= 2)",
    "budget_category_performance": "select count(distinct budget_category) from records",
    "summary_statistics": "select count(*) from (select max(id) from records)",
}
RANKED_FROM = {
    "highest_revenue": "true", "highest_budget": "true", "highest_profit": "true", "lowest_profit": "true",
    "highest_roi": "budget_musd >= 10", "lowest_roi": "budget_musd >= 10", "most_voted": "true",
    "highest_rated": "vote_count >= 10", "lowest_rated": "vote_count >= 10", "most_popular": "true",
}


def union_of_counts(counts: dict[str, str], column: str = "rows") -> str:
    return " union all ".join(f"select '{n}' as name, ({q}) as {column}" for n, q in counts.items())


RANK_COUNTS = {
    f"rankings/{n}": f"select least(10, count(*)) from records where {w}" for n, w in RANKED_FROM.items()
}
METRIC_COUNTS = {
    "temporal": "select count(*) from (select distinct release_year from records)",
    "genre": "select count(distinct genre) from genre",
    "language": "select count(*) from (select 1 from records group by original_language having count(*) >= 5)",
    "production_company": (
        "select count(*) from (select company from (select unnest(string_split(production_companies, '|')) as company "
        "from records) group by company having count(*) >= 3)"
    ),
    "director": "select count(*) from (select 1 from records where director is not null group by director having count(*) >= 2)",
    "franchise": "select count(distinct belongs_to_collection) from records",
    "director_members": "select count(*) from records where director in (select director from records group by director having count(*) >= 2)",
    "franchise_members": "select count(belongs_to_collection) from records",
    "budget_tier": "select count(distinct case when budget_musd < 10 then 1 when budget_musd < 50 then 2 when budget_musd < 100 then 3 else 4 end) from records",
    "rating_tier": "select count(distinct case when vote_average < 5 then 1 when vote_average < 7 then 2 when vote_average < 8 then 3 else 4 end) from records",
}


def exported_metrics(spark, folder):
    base = fresh_path(spark, "metrics")
    storage.export_tables(records(spark, folder), metrics.METRIC_TABLES, base)
    read = {n: spark.read.parquet(f"{base}/metrics_{n}") for n in metrics.METRIC_TABLES}
    counts = storage.row_counts(read).select("name", F.lit(None).cast("string").alias("key"), F.col("rows").cast("double").alias("value"))
    language = read["language"].select(F.lit("language").alias("name"), F.col("original_language").alias("key"), F.col("total_revenue").alias("value"))
    directors = read["director"].select(F.lit("director").alias("name"), F.col("director").alias("key"), F.col("total_revenue").alias("value"))
    return rounded(counts.unionByName(language).unionByName(directors))


EXPORTED_SQL = (
    "select name, cast(null as varchar) as key, cast(rows as double) as value from ({counts}) "
    "union all select 'language', original_language, round(sum(revenue_musd), 6) from records group by original_language having count(*) >= 5 "
    "union all select 'director', director, round(sum(revenue_musd), 6) from records where director is not null group by director having count(*) >= 2"
)


def kpi_row_counts(spark, folder):
    results = kpis.all_kpis(records(spark, folder))
    return storage.row_counts({**{n: t for n, t in results.items() if n != "rankings"},
                               **{f"rankings/{n}": t for n, t in results["rankings"].items()}})


def partitioned_by_year(spark, folder):
    base = fresh_path(spark, "partitioned")
    storage.write_stage(records(spark, folder), base, "features", "run1", ("release_year",))
    back = storage.read_stage(spark, base, "features", "run1")
    return back.where("release_year between 1997 and 1998").select("id", "title", "release_year")


def latest_of_two_runs(spark, folder):
    base = fresh_path(spark, "runs")
    table_now = records(spark, folder)
    # neither the text order nor the number order of the ids tells which was written last
    storage.write_stage(table_now.withColumn("title", F.lit("old")), base, "features", "9")
    storage.write_stage(table_now, base, "features", "10")
    return storage.read_latest(spark, base, "features").select("id", "title")


def two_outputs_from_one(spark, folder):
    base = fresh_path(spark, "shared")
    with storage.persisted(features.derive_features(cleaned(spark, folder))) as table_now:
        kpis.decade_trends(table_now).write.parquet(f"{base}/decades")
        kpis.yearly_trends(table_now).write.parquet(f"{base}/years")
    pick = ("movies_released", "total_revenue")
    decades = spark.read.parquet(f"{base}/decades").select(F.col("decade").alias("period"), *pick)
    years = spark.read.parquet(f"{base}/years").select(F.col("release_year").alias("period"), *pick)
    return rounded(decades.withColumn("kind", F.lit("decade")).unionByName(years.withColumn("kind", F.lit("year"))))


TREND = "cast(count(*) as bigint) as movies_released, round(sum(revenue_musd), 6) as total_revenue"
CREDITS_SQL = """, credit as (
  select o_orderkey as id,
    list_sort(list(distinct p_brand) filter (where p_brand is not null)) as names,
    list_sort(list(distinct s_nation || '/' || case when l_returnflag = 'R' then 'Director' else 'Producer' end)
              filter (where s_nation is not null)) as crew
  from orders left join line on o_orderkey = l_orderkey group by 1
)
select id, coalesce(array_to_string(names[1:10], '|'), '') as "cast", cast(coalesce(len(names), 0) as int) as cast_size,
  string_split(list_filter(crew, lambda m: m like '%/Director')[1], '/')[1] as director,
  cast(coalesce(len(crew), 0) as int) as crew_size
from credit"""

SOURCES = [
    case("a01_fixed_schema_scan", lambda s, d: rounded(raw(s, d).select(*RAW_FACTS)),
         sql.raw(f"select {RAW_FACTS_SQL} from raw")),
    case("a02_credit_rows", credits_from_rows, sql.raw(
        "select id, array_to_string(people, '|') as \"cast\", cast_size, director, crew_size from one_raw")),
    case("a02_credit_arrays", credits_from_arrays, sql.lines(CREDITS_SQL)),
    case("a03_select_by_id",
         lambda s, d: record_sources.select_by_id(raw(s, d), wanted_ids(s, d)).select("id", "title", "status"),
         sql.raw("select id, title, status from raw where id in (select c_custkey * 13 from customer)")),
    case("a03_missing_ids", lambda s, d: record_sources.missing_ids(raw(s, d), wanted_ids(s, d)),
         "select c_custkey * 13 as id from customer where c_custkey * 13 not in (select o_orderkey from orders)"),
    case("a04_default_ids",
         lambda s, d: record_sources.select_by_id(raw(s, d), F.broadcast(record_sources.id_table(s))).select("id", "title"),
         sql.raw(f"select id, title from raw where id in {record_sources.DEFAULT_IDS}")),
    case("a05_empty_typed",
         lambda s, d: record_sources.select_by_id(raw(s, d), record_sources.empty_records(s)).select(*RAW_FACTS),
         sql.raw(f"select {RAW_FACTS_SQL} from raw where false")),
    case("a06_raw_parquet", raw_round_trip("parquet"), sql.raw(f"select {RAW_FACTS_SQL}, genres from raw")),
    case("a06_raw_json", raw_round_trip("json"), sql.raw(f"select {RAW_FACTS_SQL}, genres from raw")),
    case("a07_stage_hand_over", stage_hand_over, sql.cleaned("select id, title, budget, genres, release_date from cleaned")),
    case("a07_repeated_empty", repeated_empty, sql.cleaned("select id, title, '1' as run from cleaned")),
    case("a12_repeated_run", repeated_run, sql.records("select id, title, release_year from records where release_year between 1995 and 1996")),
    case("a08_csv_report", csv_report, sql.records(
        "select cast(row_number() over (order by revenue_musd desc nulls last, id) as int) as rank, id, title, "
        "round(revenue_musd, 6) as revenue_musd from records order by rank limit 10")),
    case("a09_saved_results", saved_results, sql.records(SAVED_SQL)),
    case("a10_exported_metrics", exported_metrics, sql.records(EXPORTED_SQL.format(counts=union_of_counts(METRIC_COUNTS)))),
    case("a11_kpi_row_counts", kpi_row_counts, sql.records(union_of_counts({**SAVED_COUNTS, **RANK_COUNTS}))),
    case("a12_partitioned_by_year", partitioned_by_year, sql.records(
        "select id, title, release_year from records where release_year between 1997 and 1998")),
    case("a13_latest_run", latest_of_two_runs, sql.records("select id, title from records")),
    case("a14_two_outputs_from_one", two_outputs_from_one, sql.records(
        f"select 'decade' as kind, decade as period, {TREND} from records group by decade union all "
        f"select 'year', release_year, {TREND} from records group by release_year")),
]


# --- B: cleaning ----------------------------------------------------------------------------


def array_texts(column, field):
    return lambda s, d: cleaning.join_names(raw(s, d).select("id", column), {column: field})


def from_raw(columns, step):
    return lambda s, d: step(raw(s, d).select(*columns))


def genre_json(spark, folder):
    text = raw(spark, folder).select("id", F.to_json("genres").alias("genres"))
    return cleaning.parse_json_names(text, "genres")


def typed_text(spark, folder):
    text = raw(spark, folder).select(
        F.col("id").cast("string").alias("id"),
        F.col("budget").cast("string").alias("budget"),
        "release_date",
        F.col("tagline").alias("runtime"),
    )
    typed = cleaning.convert_types(text, {"id": "int", "budget": "double", "release_date": "date", "runtime": "int"})
    return typed.withColumn("release_date", F.col("release_date").cast("string"))


CLEAN_COLUMNS = (
    "id", "title", "release_date", "budget", "revenue", "runtime", "genres", "production_companies",
    "production_countries", "spoken_languages", "original_language", "belongs_to_collection", "tagline",
    "overview", "director", "cast", "cast_size", "crew_size",
)
CLEAN_SQL = ", ".join(c if c != "cast" else "array_to_string(people, '|') as \"cast\"" for c in CLEAN_COLUMNS)
FILLED = ("id", "budget", "revenue", "runtime", "director", "tagline", "belongs_to_collection", "genres")
REPAIRED = ("id", "title", "status", "budget", "revenue", "runtime", "overview", "tagline")


def conflicting(spark, folder):
    """Lines by a key that is not unique, with differing values."""
    shown = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")
    return table(spark, folder, "lineitem").select(*shown)


def conflicting_records(spark, folder):
    """Records of which some also come with another status; the order of the copies is that of the columns."""
    rows = raw(spark, folder).select("id", "title", "status", "budget", "revenue", "runtime", "overview", "tagline")
    rumored = rows.where("id % 3 = 0").withColumn("status", F.lit("Rumored"))
    late = rows.where("id % 5 = 0").withColumn("status", F.lit("Post Production"))
    return rows.unionByName(rumored).unionByName(late)


def row_index(spark, folder):
    indexed = cleaning.with_row_index(cleaned(spark, folder).select("id"))
    return indexed.agg(F.count("index").alias("n"), F.count_distinct("index").alias("distinct_n"))


CLEANING = [
    case("b01_drop_columns",
         lambda s, d: cleaning.drop_columns(
             raw(s, d).select("id", "adult", "imdb_id", "original_title", "video", "homepage", "title"), extra=["absent"]),
         sql.raw("select id, title from raw")),
    case("b02_struct_field",
         lambda s, d: cleaning.struct_field(raw(s, d).select("id", "belongs_to_collection"), "belongs_to_collection"),
         sql.raw("select id, belongs_to_collection from raw")),
    case("b03_genre_names", array_texts("genres", "name"), sql.raw("select id, genres from raw")),
    case("b04_language_names", array_texts("spoken_languages", "english_name"),
         sql.raw("select id, spoken_languages from raw")),
    case("b05_country_names", array_texts("production_countries", "name"),
         sql.raw("select id, production_countries from raw")),
    case("b06_company_names", array_texts("production_companies", "name"),
         sql.raw("select id, production_companies from raw")),
    case("b07_cast_names", array_texts("cast", None),
         sql.raw("select id, nullif(array_to_string(people, '|'), '') as \"cast\" from raw")),
    case("b08_zero_to_null", from_raw(["id", "budget", "revenue", "runtime"], cleaning.zero_to_null),
         sql.raw("select id, nullif(budget, 0) as budget, nullif(revenue, 0) as revenue, nullif(runtime, 0) as runtime from raw")),
    case("b09_placeholder_to_null", from_raw(["id", "tagline", "overview"], cleaning.placeholder_to_null),
         sql.raw("select id, nullif(remark, 'No Data') as tagline, nullif(remark, 'No Data') as overview from raw")),
    case("b09_placeholder_list",
         from_raw(["id", "tagline"], lambda df: cleaning.placeholder_to_null(df, ["tagline"], ["No Data", "N/A", "Unknown"])),
         sql.raw("select id, case when remark not in ('No Data', 'N/A', 'Unknown') then remark end as tagline from raw")),
    case("b10_one_per_key", from_raw(["id", "title", "budget"], cleaning.one_per_key),
         sql.raw("select distinct id, title, budget from raw")),
    case("b10_conflicting_copies",
         lambda s, d: rounded(cleaning.one_per_key(conflicting(s, d), ["l_orderkey", "l_linenumber"])),
         "select l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_extendedprice, 6) as l_extendedprice, round(l_quantity, 6) as l_quantity from ("
         "select *, row_number() over (partition by l_orderkey, l_linenumber order by l_partkey nulls first, l_suppkey nulls first, "
         "l_extendedprice nulls first, l_quantity nulls first) as n from lineitem) where n = 1"),
    case("b13_conflicting_records",
         lambda s, d: cleaning.repair_records(conflicting_records(s, d)).select("id", "title", "budget"),
         sql.raw("select id, title, nullif(budget, 0) as budget from (select *, row_number() over (partition by id order by title nulls first, "
                 "status nulls first, nullif(budget, 0) nulls first) as n from (select id, title, status, budget from raw "
                 "union all select id, title, 'Rumored', budget from raw where id % 3 = 0 "
                 "union all select id, title, 'Post Production', budget from raw where id % 5 = 0)) "
                 "where n = 1 and title is not null and status = 'Released'")),
    case("b10_latest_per_key",
         lambda s, d: rounded(cleaning.one_per_key(
             table(s, d, "events").select("event_id", "user_id", "ts", "event_type", "value"), "user_id", "ts", "last")
             .withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))),
         "select event_id, user_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as ts, event_type, round(value, 6) as value "
         "from (select *, row_number() over (partition by user_id order by ts desc) as rn from events) where rn = 1"),
    case("b11_require_columns", from_raw(["id", "title"], cleaning.require_columns),
         sql.raw("select id, title from raw where id is not null and title is not null")),
    case("b12_keep_status", from_raw(["id", "title", "status"], cleaning.keep_status),
         sql.raw("select id, title from raw where status = 'Released'")),
    case("b13_repair_records", from_raw(REPAIRED, cleaning.repair_records),
         sql.cleaned("select id, title, budget, revenue, runtime, overview, tagline from cleaned")),
    case("b14_flatten_nested",
         from_raw(["id", "belongs_to_collection", *cleaning.ARRAY_NAMES], cleaning.flatten_nested),
         sql.raw("select id, belongs_to_collection, genres, spoken_languages, production_countries, production_companies from raw")),
    case("b15_clean", lambda s, d: texts(cleaning.clean(raw(s, d)).select(*CLEAN_COLUMNS)),
         sql.cleaned(f"select {CLEAN_SQL} from cleaned")),
    case("b16_require_values", lambda s, d: cleaning.require_values(cleaned(s, d).select(*FILLED), 7),
         sql.cleaned(f"select {', '.join(FILLED)} from cleaned where "
                     + " + ".join(f"cast({c} is not null as int)" for c in FILLED) + " >= 7")),
    case("b17_parse_json_names", genre_json, sql.raw("select id, genres from raw")),
    case("b18_convert_types", typed_text, sql.raw(
        "select cast(id as int) as id, cast(budget as double) as budget, "
        "cast(try_cast(release_date as date) as varchar) as release_date, try_cast(remark as int) as runtime from raw")),
    case("b19_non_positive_to_null",
         lambda s, d: rounded(cleaning.non_positive_to_null(
             table(s, d, "customer").select("c_custkey", "c_acctbal"), ["c_acctbal"])),
         "select c_custkey, round(case when c_acctbal > 0 then c_acctbal end, 6) as c_acctbal from customer"),
    case("b20_order_columns",
         lambda s, d: cleaning.order_columns(cleaned(s, d).select("runtime", "title", "id", "vote_count"), features.FULL_ORDER),
         sql.cleaned("select id, title, vote_count, runtime from cleaned")),
    case("b21_final_table",
         lambda s, d: rounded(texts(features.final_table(cleaned(s, d)))),
         sql.records(
             "select id, title, tagline, release_date, genres, belongs_to_collection, original_language, "
             "round(budget_musd, 6) as budget_musd, round(revenue_musd, 6) as revenue_musd, production_companies, "
             "production_countries, vote_count, round(case when vote_count = 0 then null else vote_average end, 6) as vote_average, "
             "round(popularity, 6) as popularity, runtime, overview, spoken_languages, poster_path, "
             "cast_text as \"cast\", cast_size, director, crew_size, round(profit_musd, 6) as profit_musd, "
             "round(roi, 6) as roi, release_year from records")),
    case("b22_row_index", row_index,
         sql.cleaned("select cast(count(*) as bigint) as n, cast(count(*) as bigint) as distinct_n from cleaned")),
]


# --- C: features ------------------------------------------------------------------------------


def on_records(columns, **named):
    """Selected record columns plus computed ones."""
    return lambda s, d: rounded(records(s, d).select(*columns, *[c.alias(n) for n, c in _built(named).items()]))


def _built(named):
    return {name: column() for name, column in named.items()}


def feature_table(spark, folder):
    full = features.derive_features(cleaned(spark, folder))
    in_dollars = full.withColumn("revenue_per_minute", F.col("revenue_per_minute") * 1_000_000)
    return rounded(texts(in_dollars.drop("index", "backdrop_path")))


FEATURE_SQL = sql.records(
    "select id, title, tagline, release_date, release_year, decade, genres, belongs_to_collection, has_franchise, "
    "original_language, round(budget_musd, 6) as budget_musd, budget_category, round(revenue_musd, 6) as revenue_musd, "
    "round(profit_musd, 6) as profit_musd, round(roi, 6) as roi, round(revenue_per_minute * 1000000, 6) as revenue_per_minute, "
    "production_companies, production_countries, vote_count, round(vote_average, 6) as vote_average, rating_category, "
    "popularity, round(popularity_score, 6) as popularity_score, runtime, overview, spoken_languages, poster_path, "
    "cast_text as \"cast\", cast_size, director, crew_size from records"
)
TIER_SQL = (
    "case when budget_musd < 10 then 'Low (<$10M)' when budget_musd < 50 then 'Medium ($10M-$50M)' "
    "when budget_musd < 100 then 'High ($50M-$100M)' else 'Blockbuster (>$100M)' end"
)
RATING_TIER_SQL = (
    "case when vote_average < 5 then 'Poor (<5.0)' when vote_average < 7 then 'Average (5.0-7.0)' "
    "when vote_average < 8 then 'Good (7.0-8.0)' else 'Excellent (>8.0)' end"
)


def of_records(step, *columns):
    return lambda s, d: rounded(step(records(s, d)).select("id", *columns))


def flat_collection(spark, folder):
    nested_part = raw(spark, folder).select("id", "belongs_to_collection")
    return record_sources.flatten(nested_part)


FEATURES = [
    case("c01_to_millions",
         lambda s, d: rounded(features.to_millions(cleaned(s, d).select("id", "budget", "revenue"))),
         sql.cleaned("select id, round(budget / 1000000, 6) as budget_musd, round(revenue / 1000000, 6) as revenue_musd from cleaned")),
    case("c02_profit", on_records(["id"], profit=lambda: values.difference("revenue_musd", "budget_musd")),
         sql.records("select id, round(revenue_musd - budget_musd, 6) as profit from records")),
    case("c03_roi_ratio", on_records(["id"], roi=lambda: values.ratio_of_positive("revenue_musd", "budget_musd")),
         sql.records("select id, round(case when budget_musd > 0 then revenue_musd / budget_musd end, 6) as roi from records")),
    case("c04_roi_percent",
         on_records(["id"], gain=lambda: values.percent_gain("revenue_musd", "budget_musd"),
                    gain_rounded=lambda: values.percent_gain_of_positive("revenue_musd", "budget_musd")),
         sql.records("select id, round((revenue_musd / budget_musd - 1) * 100, 6) as gain, "
                     "round(case when budget_musd > 0 then (revenue_musd / budget_musd - 1) * 100 end, 2) as gain_rounded from records")),
    case("c05_revenue_per_minute",
         lambda s, d: rounded(cleaned(s, d).select("id", values.ratio_of_positive("revenue", "runtime").alias("per_minute"))),
         sql.cleaned("select id, round(case when runtime > 0 then revenue / runtime end, 6) as per_minute from cleaned")),
    case("c06_release_year",
         lambda s, d: features.add_release_year(cleaned(s, d).select("id", "release_date")),
         sql.records("select id, release_date, release_year from records")),
    case("c07_decade", of_records(features.add_decade, "decade"), sql.records("select id, decade from records")),
    case("c08_date_parts",
         lambda s, d: features.add_date_parts(table(s, d, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate")
         .drop("o_orderdate"),
         "select o_orderkey, cast(year(o_orderdate) as int) as year, cast(month(o_orderdate) as int) as month, "
         "cast(quarter(o_orderdate) as int) as quarter from orders"),
    case("c09_blank_unvoted_rating", of_records(features.blank_unvoted_rating, "vote_average"),
         sql.records("select id, round(case when vote_count = 0 then null else vote_average end, 6) as vote_average from records")),
    case("c10_membership",
         of_records(lambda df: features.add_membership_label(features.add_membership(df)), "has_franchise", "is_franchise"),
         sql.records("select id, has_franchise, case when has_franchise then 'Franchise' else 'Standalone' end as is_franchise from records")),
    case("c11_popularity_score", of_records(features.add_popularity_score, "popularity_score"),
         sql.records("select id, round(popularity_score, 6) as popularity_score from records")),
    case("c12_budget_category", of_records(features.add_budget_category, "budget_category"),
         sql.records("select id, budget_category from records")),
    case("c12_budget_category_known",
         of_records(lambda df: features.add_budget_category(df, null_label="Unknown"), "budget_category"),
         sql.records("select id, case when budget_musd is null then 'Unknown' else budget_category end as budget_category from records")),
    case("c13_rating_category", of_records(features.add_rating_category, "rating_category"),
         sql.records("select id, rating_category from records")),
    case("c14_budget_tier", of_records(features.add_budget_tier, "budget_tier"),
         sql.records(f"select id, {TIER_SQL} as budget_tier from records")),
    case("c15_rating_tier", of_records(features.add_rating_tier, "rating_tier"),
         sql.records(f"select id, {RATING_TIER_SQL} as rating_tier from records")),
    case("c16_divide_or",
         lambda s, d: rounded(cleaned(s, d).select(
             "id", values.divide_or("revenue", "cast_size").alias("plain"),
             values.divide_or("budget", "runtime", -1.0).alias("marked"))),
         sql.cleaned("select id, round(case when cast_size <> 0 then revenue / cast_size else 0.0 end, 6) as plain, "
                     "round(case when runtime <> 0 then budget / runtime else -1.0 end, 6) as marked from cleaned")),
    case("c17_parse_date",
         lambda s, d: raw(s, d).select(
             "id", dates.as_date("release_date", "yyyy-MM-dd").cast("string").alias("day"), dates.year_of("release_date").alias("year")),
         sql.raw("select id, cast(try_cast(release_date as date) as varchar) as day, "
                 "cast(year(try_cast(release_date as date)) as int) as year from raw")),
    case("c18_money_text",
         lambda s, d: records(s, d).select(
             "id", values.money_text(F.floor(F.col("revenue_musd") * 100) / 100 * 1000).alias("money"),
             values.percent_text(F.col("vote_count") / 4).alias("share")),
         sql.records("select id, format('${:,.2f}M', floor(revenue_musd * 100) / 100 * 1000) as money, "
                     "format('{:.2f}%', vote_count / 4) as share from records")),
    case("c19_flatten", flat_collection, sql.raw(
        "select id, case when belongs_to_collection is not null then cast(collection_id as int) end as belongs_to_collection_id, "
        "belongs_to_collection as belongs_to_collection_name, cast(null as varchar) as belongs_to_collection_poster_path, "
        "cast(null as varchar) as belongs_to_collection_backdrop_path from raw")),
    case("c20_shorten",
         lambda s, d: table(s, d, "documents").select("doc_id", values.shorten("text", 25).alias("label")),
         "select doc_id, case when length(text) > 25 then substring(text, 1, 25) || '...' else text end as label from documents"),
    case("c21_first_token", on_records(["id"], primary_genre=lambda: nested.first_token("genres")),
         sql.records("select id, string_split(genres, '|')[1] as primary_genre from records")),
    # sevenths, because amounts in full dollars would often end exactly on a rounding edge
    case("c22_rounded_profit",
         on_records(["id"], profit=lambda: values.difference(F.col("revenue_musd") / 7, F.col("budget_musd") / 7, 2)),
         sql.records("select id, round(revenue_musd / 7 - budget_musd / 7, 2) as profit from records")),
    case("c23_feature_table", feature_table, FEATURE_SQL),
]

CASES = [*SOURCES, *CLEANING, *FEATURES]
