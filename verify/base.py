"""Query cases, the record stages they run on, and the same stages as SQL."""

from __future__ import annotations

import threading
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordwise.operators import cleaning, features
from recordwise.operators.sizing import fresh_path
from verify.order_records import order_records, table
from recordwise.sources.records import read_records

__all__ = ["Case", "OFFSET", "averaged", "batch_base", "case", "cleaned", "fresh_path", "raw", "records", "rounded", "sql", "table", "texts"]


@dataclass(frozen=True)
class Case:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


def case(name: str, build: Callable[[SparkSession, str], DataFrame], sql: str | None = None) -> Case:
    return Case(name, build, sql)


# --- stages -----------------------------------------------------------------------------

_written: dict[tuple[str, str, str], str] = {}
_lock = threading.RLock()


def _stage(spark: SparkSession, folder: str, name: str, build: Callable[[], DataFrame]) -> str:
    """Path of a stage table, written once per Spark application and input folder.

    As in the batch run, each stage is handed over as Parquet, so the queries read only
    their own columns and push their filters into the scan.
    """
    key = (spark.sparkContext.applicationId, folder, name)
    with _lock:
        if key not in _written:
            path = fresh_path(spark, name)
            build().write.parquet(path)
            _written[key] = path
    return _written[key]


def raw(spark: SparkSession, folder: str) -> DataFrame:
    path = _stage(spark, folder, "raw", lambda: order_records(spark, folder))
    return read_records(spark, path)


def cleaned(spark: SparkSession, folder: str) -> DataFrame:
    source = raw(spark, folder)
    return spark.read.parquet(_stage(spark, folder, "cleaned", lambda: cleaning.clean(source, settle_repeated=True)))


def records(spark: SparkSession, folder: str) -> DataFrame:
    source = cleaned(spark, folder)
    build = lambda: features.derive_features(source)
    return spark.read.parquet(_stage(spark, folder, "features", build))


def batch_base(spark: SparkSession, folder: str, run: Callable[[str], object]) -> str:
    """Base folder of a batch run, made once per application and input folder."""
    raw(spark, folder)
    key = (spark.sparkContext.applicationId, folder, "batch")
    with _lock:
        if key not in _written:
            base = fresh_path(spark, "batch")
            run(base)
            _written[key] = base
    return _written[key]


# --- comparable results -----------------------------------------------------------------


# Averages of amounts with few decimals often end exactly halfway between two rounded values,
# where the order of summation would decide. Both sides add this offset before rounding.
OFFSET = 3.7e-10


def rounded(df: DataFrame, offset: float = 0.0) -> DataFrame:
    """Doubles rounded to 6 digits, so that the order of summation does not show."""
    def one(field: T.StructField) -> str:
        name = f"`{field.name}`"
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            return f"round({name} + {offset!r}d, 6) as {name}"
        return name

    return df.selectExpr(*[one(field) for field in df.schema.fields])


def averaged(df: DataFrame) -> DataFrame:
    return rounded(df, OFFSET)


def texts(df: DataFrame) -> DataFrame:
    """String arrays joined to text."""
    arrays = [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]
    return df.withColumns({c: F.array_join(c, "|") for c in arrays}) if arrays else df


# --- the same stages as SQL ---------------------------------------------------------------

POSITION = "l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate"

LINES = """
line as (
  select l.*, s.s_name, sn.n_name as s_nation, p.p_type, p.p_brand
  from lineitem l
  join supplier s on l.l_suppkey = s.s_suppkey
  join nation sn on s.s_nationkey = sn.n_nationkey
  join part p on l.l_partkey = p.p_partkey
)"""

RAW = f"""{LINES},
per_order as (
  select l_orderkey as k,
    count(*) as n_lines,
    sum(cast(l_extendedprice as decimal(18,2))) as price,
    cast(sum(cast(round(l_discount * 100) as bigint)) as bigint) as discounts,
    cast(sum(cast(round(l_tax * 100) as bigint)) as bigint) as taxes,
    cast(sum(cast(l_quantity as bigint)) as bigint) as quantity,
    array_to_string(list_sort(list(distinct p_type)), '|') as types,
    array_to_string(list_sort(list(distinct p_brand)), '|') as brands,
    array_to_string(list_sort(list(distinct s_nation)), '|') as nations,
    list(s_name order by {POSITION})[1:10] as people,
    (list(s_name order by {POSITION}) filter (where l_returnflag = 'R'))[1] as director
  from line group by 1
),
one_raw as (
  select o_orderkey as id,
    case when o_orderkey % 211 <> 0 then 'Order#' || o_orderkey end as title,
    'tt' || o_orderkey as imdb_id,
    'Order#' || o_orderkey as original_title,
    case o_orderstatus when 'F' then 'Released' when 'O' then 'Rumored' else 'Post Production' end as status,
    case when o_orderkey % 97 = 0 then '' else strftime(o_orderdate, '%Y-%m-%d') end as release_date,
    case when o_orderkey % 50 = 0 then 0 else cast(price * 500 as bigint) end as budget,
    case when o_orderkey % 70 = 0 then 0
         else cast(cast(o_totalprice as decimal(18,2)) * 500 as bigint) end as revenue,
    case when o_orderkey % 60 = 0 then 0 else cast(n_lines * 10 as int) end as runtime,
    coalesce(discounts / n_lines, 0.0) as vote_average,
    cast(coalesce(quantity, 0) as int) as vote_count,
    cast(taxes as double) as popularity,
    types as genres, brands as production_companies, nations as production_countries,
    case when o_custkey % 10 <> 0 then cn.n_name else '' end as spoken_languages,
    cn.n_name as original_language,
    case when o_orderpriority <> '4-NOT SPECIFIED' then c_mktsegment || ' ' || cn.n_name end as belongs_to_collection,
    length(c_mktsegment) * 100 + c_nationkey as collection_id,
    coalesce(people, []) as people,
    cast(coalesce(n_lines, 0) as int) as cast_size,
    cast(coalesce(n_lines, 0) as int) as crew_size,
    director,
    case o_orderpriority when '5-LOW' then 'No Data' when '1-URGENT' then 'N/A' else o_orderpriority end as remark,
    '/p' || o_orderkey as poster_path
  from orders
  left join per_order on o_orderkey = k
  left join customer on o_custkey = c_custkey
  left join nation cn on c_nationkey = cn.n_nationkey
),
raw as (
  select * from one_raw union all select * from one_raw where id % 101 = 0
)"""

CLEANED = f"""{RAW},
cleaned as (
  select distinct id, title, release_date,
    nullif(budget, 0) as budget, nullif(revenue, 0) as revenue, nullif(runtime, 0) as runtime,
    vote_average, vote_count, popularity, genres, production_companies, production_countries,
    spoken_languages, original_language, belongs_to_collection, people, cast_size, crew_size, director,
    nullif(remark, 'No Data') as tagline, nullif(remark, 'No Data') as overview, poster_path
  from raw
  where title is not null and status = 'Released'
)"""

RECORDS = f"""{CLEANED},
money as (
  select * exclude (budget, revenue),
    budget / 1000000 as budget_musd, revenue / 1000000 as revenue_musd,
    cast(year(try_cast(release_date as date)) as int) as release_year
  from cleaned
),
records as (
  select *,
    revenue_musd - budget_musd as profit_musd,
    case when budget_musd > 0 then revenue_musd / budget_musd end as roi,
    case when runtime > 0 then revenue_musd / runtime end as revenue_per_minute,
    cast(floor(release_year / 10) * 10 as int) as decade,
    belongs_to_collection is not null as has_franchise,
    case when budget_musd < 1 then 'Micro' when budget_musd < 10 then 'Low' when budget_musd < 50 then 'Medium'
         when budget_musd < 100 then 'High' else 'Blockbuster' end as budget_category,
    case when vote_average < 3 then 'Poor' when vote_average < 5 then 'Below Average'
         when vote_average < 6.5 then 'Average' when vote_average < 7.5 then 'Good'
         when vote_average < 8.5 then 'Very Good' else 'Excellent' end as rating_category,
    vote_average / 10.0 * 0.3 + ln(1 + vote_count) / 10.0 * 0.3 + popularity / 100.0 * 0.4 as popularity_score,
    array_to_string(people, '|') as cast_text
  from money
),
genre as (
  select records.*, unnest(string_split(genres, '|')) as genre from records where genres is not null
)"""


class sql:
    """Complete statements over one of the stages."""

    @staticmethod
    def lines(body: str) -> str:
        return f"with {LINES}\n{body}"

    @staticmethod
    def raw(body: str) -> str:
        return f"with {RAW}\n{body}"

    @staticmethod
    def cleaned(body: str) -> str:
        return f"with {CLEANED}\n{body}"

    @staticmethod
    def records(body: str) -> str:
        return f"with {RECORDS}\n{body}"

    @staticmethod
    def select(measures: dict[str, str], source: str, keys: tuple[str, ...] = (), tail: str = "") -> str:
        """``select keys, measures from source group by keys`` with rounded measures."""
        columns = [*keys, *[f"{sql.value(expr)} as {name}" for name, expr in measures.items()]]
        group = f" group by {', '.join(keys)}" if keys else ""
        return f"select {', '.join(columns)} from {source}{group} {tail}"

    @staticmethod
    def value(expr: str) -> str:
        """Counts and sums of counts as bigint, text as it is, everything else rounded."""
        if expr.startswith("count("):
            return f"cast({expr} as bigint)"
        if expr.startswith("="):
            return expr[1:]
        return f"round({expr} + {OFFSET}, 6)"
