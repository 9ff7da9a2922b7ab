import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordwise.operators import cleaning, features
from recordwise.sources import records

pytestmark = pytest.mark.literal


def test_drop_columns_ignores_absent_names(spark):
    df = spark.createDataFrame([(7, "yes", "tt7", "Kelp", 3)], "id int, adult string, imdb_id string, title string, pages int")
    assert cleaning.drop_columns(df, extra=["pages", "no such column"]).columns == ["id", "title"]


def test_zero_becomes_null_and_other_numbers_stay(spark):
    df = spark.createDataFrame([(5, 0, -3.5), (6, 12, 0.0), (7, None, float("nan"))], "id int, runtime int, budget double")
    rows = {r["id"]: (r["runtime"], r["budget"]) for r in cleaning.zero_to_null(df, ["runtime", "budget"]).collect()}
    assert rows[5] == (None, -3.5) and rows[6] == (12, None)
    assert rows[7][0] is None and rows[7][1] != rows[7][1]


def test_non_positive_becomes_null(spark):
    df = spark.createDataFrame([(v,) for v in (-2.5, -0.0, 1e-9, 41.0)], "budget double")
    assert [r[0] for r in cleaning.non_positive_to_null(df, ["budget"]).collect()] == [None, None, 1e-9, 41.0]


def test_type_conversion_gives_null_for_what_does_not_fit(spark):
    rows = [("12", "7.25", "1987-11-30"), ("12.9.1", "seven", "1987-13-01"), (None, " 8 ", "30.11.1987")]
    typed = cleaning.convert_types(spark.createDataFrame(rows, "id string, budget string, release_date string"),
                                   {"id": "int", "budget": "double", "release_date": "date"})
    assert [f.dataType for f in typed.schema.fields] == [T.IntegerType(), T.DoubleType(), T.DateType()]
    got = [(r["id"], r["budget"], str(r["release_date"])) for r in typed.collect()]
    assert got == [(12, 7.25, "1987-11-30"), (None, None, "None"), (None, 8.0, "None")]


def test_placeholders(spark):
    df = spark.createDataFrame([("No Data",), ("N/A",), ("text",), (None,)], "tagline string")
    assert [r[0] for r in cleaning.placeholder_to_null(df, ["tagline"]).collect()] == [None, "N/A", "text", None]
    both = cleaning.placeholder_to_null(df, ["tagline"], ["No Data", "N/A"])
    assert [r[0] for r in both.collect()] == [None, None, "text", None]


def test_conflicting_copies_give_one_result_for_every_layout(spark):
    rows = [(k, s, {"n": n}, [n, k]) for k in range(40) for s, n in (("Rumored", 2), ("Released", 1), ("Released", 3), (None, 9))]
    df = spark.createDataFrame(rows, "id int, status string, facts map<string, int>, list array<int>")
    results = []
    for frame in (df.coalesce(1), df.repartition(7), df.orderBy(F.desc("status"), "list").repartition(3, "list")):
        kept = cleaning.one_per_key(frame)
        results.append(sorted((r["id"], r["status"], r["facts"]["n"]) for r in kept.collect()))
    assert results[0] == results[1] == results[2] == [(k, None, 9) for k in range(40)]


def test_several_keys(spark):
    rows = [(1, "a", 5.0), (1, "b", 4.0), (1, "a", 2.5), (None, "a", 1.0), (None, "a", 0.5)]
    kept = cleaning.one_per_key(spark.createDataFrame(rows, "x int, y string, v double"), ["x", "y"]).collect()
    assert sorted(r["v"] for r in kept) == [0.5, 2.5, 4.0]


@pytest.mark.parametrize("keep, expected", [("first", "old"), ("last", "new")])
def test_ordered_deduplication_is_repeatable(spark, keep, expected):
    rows = [(1, "new", 9), (1, "old", 3), (1, "unknown", None), (2, "only", None)]
    for parts in (1, 3):
        df = spark.createDataFrame(rows, "id int, title string, version int").repartition(parts)
        kept = {r["id"]: r["title"] for r in cleaning.one_per_key(df, "id", "version", keep).collect()}
        assert kept == {1: expected, 2: "only"}


def test_status_filter_drops_the_column(spark):
    df = spark.createDataFrame([(4, "Released"), (5, "released"), (6, None), (7, "Planned")], "id int, status string")
    assert [tuple(r) for r in cleaning.keep_status(df).collect()] == [(4,)]
    assert [tuple(r) for r in cleaning.keep_status(df, "Planned").collect()] == [(7,)]


def test_millions(spark):
    df = spark.createDataFrame([(9, 2_500_000.0, None)], "id int, budget double, revenue double")
    assert tuple(features.to_millions(df).first()) == (9, 2.5, None)


def test_required_columns_and_thresholds(spark):
    rows = [(21, "Kelp", None, None), (None, "Lantern", 4, 4), (23, None, 5, None), (24, "Nettle", 6, 6)]
    df = spark.createDataFrame(rows, "id int, title string, n int, m int")
    assert sorted(r["id"] for r in cleaning.require_columns(df).collect()) == [21, 24]
    assert cleaning.require_values(df, 3).count() == 2


def test_frames_without_rows_and_without_values(spark):
    empty = spark.createDataFrame([], "id int, title string")
    assert cleaning.one_per_key(cleaning.require_columns(empty)).count() == 0
    nothing = spark.createDataFrame([(None, None)] * 4, "id int, budget double")
    assert cleaning.one_per_key(cleaning.zero_to_null(nothing, ["budget"])).count() == 1


def test_unusual_titles_survive(spark):
    titles = ["tab\there", "line\nbreak", "semi;colon|bar", "\u00e9\u0301 \U0001f40c", "", " "]
    df = spark.createDataFrame(list(enumerate(titles)), "id int, title string")
    kept = cleaning.require_columns(cleaning.one_per_key(df))
    assert sorted(r["title"] for r in kept.collect()) == sorted(titles)


def raw_row(**cells):
    base = {"id": 1, "title": "T", "status": "Released", "budget": 5, "revenue": 0, "runtime": 90, "overview": "No Data",
            "release_date": "2001-05-06", "vote_average": 7.0, "vote_count": 3, "popularity": 1.0,
            "genres": [{"id": 1, "name": "Action"}], "spoken_languages": [{"name": "x"}],
            "belongs_to_collection": {"id": 9, "name": "Saga"}, "cast": ["P", "Q"]}
    return {**base, **cells}


def test_full_cleaning_and_features(spark):
    rows = [raw_row(), raw_row(id=2, status="Rumored"), raw_row(id=3, title=None), raw_row(),
            raw_row(id=4, genres=[], belongs_to_collection=None, budget=0)]
    cleaned = cleaning.clean(spark.createDataFrame(rows, records.RECORD_SCHEMA))
    by_id = {r["id"]: r for r in cleaned.collect()}
    assert sorted(by_id) == [1, 4]
    first = by_id[1]
    assert (first["genres"], first["spoken_languages"], first["belongs_to_collection"]) == ("Action", "", "Saga")
    assert (first["revenue"], first["overview"], by_id[4]["genres"], by_id[4]["budget"]) == (None, None, None, None)
    assert not {"status", "adult", "video"} & set(cleaned.columns)
    table = features.derive_features(cleaned)
    assert table.columns == [c for c in features.FULL_ORDER] + ["index"]
    row = table.where("id = 1").first()
    assert (row["budget_musd"], row["profit_musd"], row["roi"], row["release_year"], row["decade"]) == (5e-6, None, None, 2001, 2000)
    assert (row["has_franchise"], row["budget_category"], table.where("id = 4").first()["budget_category"]) == (True, "Micro", "Blockbuster")
    final = features.final_table(cleaned)
    assert set(final.columns) == set(features.FINAL_COLUMNS)


def test_rating_is_blank_only_for_zero_votes(spark):
    df = spark.createDataFrame([(0, 5.0), (3, 6.0), (None, 7.0)], "vote_count int, vote_average double")
    assert [r["vote_average"] for r in features.blank_unvoted_rating(df).collect()] == [None, 6.0, 7.0]


def test_row_index_is_unique_and_increasing(spark):
    df = cleaning.with_row_index(spark.range(100).repartition(5))
    assert df.select(F.count_distinct("index")).first()[0] == 100
