"""Raw record schema, credits, and selection of records by id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordwise.functions.nested import leaf_columns

# The raw record layout. Ids are 64 bits wide and scores are doubles.
DETAIL_SCHEMA = (
    "adult string, backdrop_path string, "
    "belongs_to_collection struct<id: int, name: string, poster_path: string, backdrop_path: string>, "
    "budget bigint, genres array<struct<id: int, name: string>>, homepage string, id bigint not null, "
    "imdb_id string, original_language string, original_title string, overview string, "
    "popularity double, poster_path string, "
    "production_companies array<struct<name: string, id: int, logo_path: string, origin_country: string>>, "
    "production_countries array<struct<iso_3166_1: string, name: string>>, release_date string, "
    "revenue bigint, runtime int, "
    "spoken_languages array<struct<iso_639_1: string, name: string, english_name: string>>, "
    "status string, tagline string, title string, video string, vote_average double, vote_count int"
)
CREDIT_COLUMNS = "cast array<string>, cast_size int, director string, crew_size int"
RECORD_SCHEMA = f"{DETAIL_SCHEMA}, {CREDIT_COLUMNS}"
CREDITS_SCHEMA = "id bigint not null, cast array<struct<name: string>>, crew array<struct<name: string, job: string>>"
CAST_LIMIT = 10  # fixed value: by default a record lists its first ten cast members
DIRECTOR_JOB = "Director"

# The default record ids.
DEFAULT_IDS = (
    0, 299534, 19995, 140607, 299536, 597, 135397, 420818, 24428, 168259, 99861, 284054, 12445, 181808,
    330457, 351286, 109445, 321612, 260513,
)


def read_records(
    spark: SparkSession, path: str | Sequence[str], fmt: str = "parquet", schema: str | T.StructType = RECORD_SCHEMA
) -> DataFrame:
    """Scan landed records with the fixed schema; nothing is inferred."""
    return spark.read.schema(schema).format(fmt).load(path if isinstance(path, str) else list(path))


def empty_records(spark: SparkSession, schema: str | T.StructType = RECORD_SCHEMA) -> DataFrame:
    return spark.createDataFrame([], schema)


def id_table(spark: SparkSession, ids: Sequence[int] = DEFAULT_IDS, key: str = "id") -> DataFrame:
    return spark.createDataFrame([(int(i),) for i in dict.fromkeys(ids)], f"{key} bigint")


def select_by_id(records: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """Records whose id is listed; listed ids without a record are skipped."""
    return records.join(ids.select(key), key, "left_semi")


def missing_ids(records: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """Listed ids without a record."""
    return ids.select(key).distinct().join(records.select(key).distinct(), key, "left_anti")


def attach_credits(
    details: DataFrame, credits: DataFrame, key: str = "id", cast_limit: int | None = CAST_LIMIT
) -> DataFrame:
    """Add cast, cast size, director and crew size from nested credits, one row per record.

    A record without credits gets an empty cast, zero sizes and no director; credits
    without a record are left out. ``cast_limit`` None lists the whole cast.
    """
    names = F.transform("cast", lambda member: member.getField("name"))
    directors = F.filter("crew", lambda member: member.getField("job") == DIRECTOR_JOB)
    summary = credits.select(
        key,
        (names if cast_limit is None else F.slice(names, 1, cast_limit)).alias("cast"),
        F.size("cast").alias("cast_size"),
        F.get(directors, F.lit(0)).getField("name").alias("director"),
        F.size("crew").alias("crew_size"),
    )
    return with_defaults(details.join(summary, key, "left"))


def attach_credit_rows(
    details: DataFrame,
    cast: DataFrame,
    crew: DataFrame,
    position: Sequence[str],
    key: str = "id",
    cast_limit: int | None = CAST_LIMIT,
) -> DataFrame:
    """``attach_credits`` for credits stored one row per person.

    ``cast`` has the key, ``name`` and the ``position`` columns, ``crew`` also ``job``. Both
    sides are cut down before their shuffle: cast rows to the first ``cast_limit`` of each record
    (None: all), crew rows to one director and a count, so a record with very many people stays
    cheap.
    """
    order = [F.asc(p) for p in position]
    placed = cast.select(key, "name", *position).withColumn(
        "place", F.row_number().over(Window.partitionBy(key).orderBy(*order))
    )
    first = (
        (placed if cast_limit is None else placed.where(F.col("place") <= cast_limit))
        .groupBy(key)
        .agg(F.array_sort(F.collect_list(F.struct("place", "name"))).alias("people"))
        .select(key, F.col("people.name").alias("cast"))
    )
    count = F.count(F.lit(1)).cast("int")
    director = F.min_by("name", F.when(F.col("job") == DIRECTOR_JOB, F.struct(*position))).alias("director")
    if cast is crew:  # one table of people: its sizes and directors are one grouping
        facts = cast.groupBy(key).agg(count.alias("cast_size"), director, count.alias("crew_size"))
        return with_defaults(details.join(first, key, "left").join(facts, key, "left"))
    cast_sizes = cast.groupBy(key).agg(count.alias("cast_size"))
    crew_facts = crew.groupBy(key).agg(director, count.alias("crew_size"))
    joined = details.join(first, key, "left").join(cast_sizes, key, "left").join(crew_facts, key, "left")
    return with_defaults(joined)


def with_defaults(df: DataFrame) -> DataFrame:
    """Credits of records without any: an empty cast and zero sizes."""

    def known(column: str, default: Column) -> Column:
        return F.coalesce(F.col(column), default)

    return df.withColumns(
        {
            "cast": known("cast", F.array().cast("array<string>")),
            "cast_size": known("cast_size", F.lit(0)),
            "crew_size": known("crew_size", F.lit(0)),
        }
    )


def flatten(df: DataFrame, separator: str = "_") -> DataFrame:
    """All struct fields as top-level columns named by their joined path."""
    return df.select(*leaf_columns(df.schema, separator))
