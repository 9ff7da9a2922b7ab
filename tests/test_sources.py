import json

import pytest
from pyspark.sql import functions as F

from recordwise.operators.sizing import broadcast_if_small, fresh_path, measured_bytes
from recordwise.sources import records, storage

pytestmark = pytest.mark.literal


@pytest.fixture
def credits(spark):
    many = [{"name": f"n{i}"} for i in range(13)]
    rows = [
        {"id": 1, "cast": many, "crew": [{"name": "p", "job": "Producer"}, {"name": "d1", "job": "Director"}, {"name": "d2", "job": "Director"}]},
        {"id": 2, "cast": [], "crew": []},
        {"id": 99, "cast": many, "crew": []},
    ]
    return spark.createDataFrame(rows, records.CREDITS_SCHEMA)


EXPECTED = {
    1: ([f"n{i}" for i in range(10)], 13, "d1", 3),
    2: ([], 0, None, 0),
    3: ([], 0, None, 0),
}


def as_dict(df):
    return {r["id"]: (r["cast"], r["cast_size"], r["director"], r["crew_size"]) for r in df.collect()}


def test_nested_credits(spark, credits):
    details = spark.range(1, 4)
    assert as_dict(records.attach_credits(details, credits)) == EXPECTED


def test_credit_rows_agree_with_nested_credits(spark, credits):
    cast = credits.select("id", F.posexplode("cast").alias("place_no", "m")).select("id", "place_no", F.col("m.name").alias("name"))
    crew = credits.select("id", F.posexplode("crew").alias("place_no", "m")).select(
        "id", "place_no", F.col("m.name").alias("name"), F.col("m.job").alias("job"))
    full = records.attach_credit_rows(spark.range(1, 4), cast.repartition(5), crew.repartition(3), ["place_no"])
    assert as_dict(full) == EXPECTED


def test_selection_by_id(spark):
    landed = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "id bigint, title string")
    ids = records.id_table(spark, [2, 7, 2])
    assert [r["id"] for r in records.select_by_id(landed, ids).collect()] == [2, 2]
    assert [r["id"] for r in records.missing_ids(landed, ids).collect()] == [7]
    assert records.id_table(spark).count() == 19


def test_empty_records_are_typed(spark):
    empty = records.empty_records(spark)
    assert (empty.count(), len(empty.columns)) == (0, 29)


def test_json_records_with_a_fixed_schema(spark, tmp_path):
    response = {"id": 5, "title": "T", "budget": 7, "genres": [{"id": 1, "name": "A"}], "vote_average": 7,
                "spoken_languages": [{"iso_639_1": "en", "name": "English"}], "surplus": "ignored"}
    (tmp_path / "r.json").write_text(json.dumps(response))
    row = records.read_records(spark, str(tmp_path / "r.json"), "json").first()
    assert (row["id"], row["vote_average"], row["genres"][0]["name"], row["runtime"]) == (5, 7.0, "A", None)
    assert "surplus" not in row.asDict()


def test_stages_runs_and_pruning(spark):
    base = fresh_path(spark, "t")
    for run, n in (("007", 3), ("010", 5)):
        df = spark.range(n).withColumn("release_year", (F.col("id") % 2 + 1999).cast("int"))
        storage.write_stage(df, base, "features", run, ("release_year",))
    storage.write_stage(spark.range(4).withColumn("release_year", F.lit(1999)), base, "features", "007", ("release_year",))
    assert storage.read_stage(spark, base, "features", "010").count() == 5
    assert storage.latest_run(spark, base, "features") == "007"  # written last, whatever the names are
    assert storage.read_latest(spark, base, "features").count() == 4
    only = storage.read_stage(spark, base, "features", "010").where("release_year = 1999")
    plan = only._jdf.queryExecution().executedPlan().toString()
    partition_filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "release_year" in partition_filters and "run_id=007" not in plan


def test_save_results_dispatch(spark):
    base = fresh_path(spark, "t")
    results = {"table": spark.range(3), "many": {"x": spark.range(1), "y": spark.range(2)}, "numbers": {"n": 5, "t": "q"}, "other": 7}
    kinds = {r["name"]: r["kind"] for r in storage.save_results(spark, results, base).collect()}
    assert kinds == {"table": "table", "many/x": "table", "many/y": "table", "numbers": "values", "other": "skipped"}
    assert spark.read.parquet(f"{base}/many/y").count() == 2
    assert spark.read.json(f"{base}/numbers.json").first()["n"] == 5


def test_export_reports_failures_and_goes_on(spark):
    base = fresh_path(spark, "t")
    tables = {"bad": lambda df: df.select("absent"), "good": lambda df: df}
    status = {r["name"]: r for r in storage.export_tables(spark.range(2), tables, base).collect()}
    assert status["bad"]["path"] is None and "absent" in status["bad"]["error"]
    assert status["good"]["error"] is None and spark.read.parquet(status["good"]["path"]).count() == 2


def test_single_file_is_the_callers_choice(spark):
    import glob

    one, many = fresh_path(spark, "t"), fresh_path(spark, "t")
    storage.write_csv(spark.range(1000).repartition(4), one, single_file=True)
    storage.write_csv(spark.range(1000).repartition(4), many)
    count = lambda path: len(glob.glob(path.removeprefix("file:") + "/part-*"))
    assert (count(one), count(many)) == (1, 4)


def test_a_repeated_run_leaves_nothing_of_the_earlier_one(spark):
    base = fresh_path(spark, "t")
    years = spark.range(6).selectExpr("id", "cast(2000 + id % 3 as int) as release_year")
    storage.write_stage(years, base, "features", "r", ("release_year",))
    storage.write_stage(years.where("release_year = 2001"), base, "features", "r", ("release_year",))
    assert storage.read_stage(spark, base, "features", "r").count() == 2
    storage.write_stage(years.limit(0), base, "features", "r", ("release_year",))
    assert storage.read_stage(spark, base, "features", "r").count() == 0
    storage.write_stage(years.selectExpr("id", "cast(null as int) as release_year"), base, "features", "n", ("release_year",))
    read = storage.read_stage(spark, base, "features", "n")
    assert read.dtypes == years.dtypes and read.where("release_year is null").count() == 6


def test_raw_records_are_kept_per_run(spark):
    base = fresh_path(spark, "t")
    storage.write_raw(spark.range(3), base, "a")
    storage.write_raw(spark.range(5), base, "b")
    assert [spark.read.parquet(storage.raw_path(base, run)).count() for run in ("a", "b")] == [3, 5]


def test_attempts_of_a_run(spark):
    base = fresh_path(spark, "t")
    assert storage.next_attempt(spark, base, "r") == 1
    storage.append_run_records(spark, base, [("r", 1, "clean", "succeeded", 0.0, "broken")])
    assert (storage.next_attempt(spark, base, "r"), storage.next_attempt(spark, base, "other")) == (2, 1)


def test_whole_cast_on_request(spark, credits):
    full = {r["id"]: r["cast"] for r in records.attach_credits(spark.range(1, 4), credits, cast_limit=None).collect()}
    assert len(full[1]) == 13


def test_broadcast_depends_on_measured_size(spark):
    df = spark.range(1000).select("id", F.repeat(F.lit("x"), 100).alias("t"))
    assert measured_bytes(df) > 100_000
    marked = lambda d: "hint" in d._jdf.queryExecution().logical().toString().lower()
    assert marked(broadcast_if_small(df, 10**6))
    assert not marked(broadcast_if_small(df, 10**4))


def test_a_failed_rewrite_leaves_the_earlier_rows(spark):
    base = fresh_path(spark, "t")
    storage.write_stage(spark.range(5), base, "cleaned", "r")
    for partition_by in ((), ("k",)):
        with pytest.raises(Exception, match="broken"):
            storage.write_stage(spark.range(9).selectExpr("if(id > 7, raise_error('broken'), id) as id", "id % 2 as k"), base, "cleaned", "r", partition_by)
        assert storage.read_latest(spark, base, "cleaned").count() == 5
    storage.write_stage(spark.range(2), base, "cleaned", "r")
    storage.write_stage(spark.range(3), base, "cleaned", "other")
    assert len(storage.remove_superseded(spark, base, "cleaned", "r")) >= 2
    assert [storage.read_stage(spark, base, "cleaned", run).count() for run in ("r", "other")] == [2, 3]
    assert storage.remove_superseded(spark, base, "cleaned", "r") == []


def test_logs_stay_short(spark):
    path, schema = fresh_path(spark, "log"), "n int"
    for n in range(23):
        storage.append_log(spark.createDataFrame([(n,)], schema), path, schema, most_files=4)
    assert len(storage._data_files(spark, path)) <= 5
    assert sorted(r.n for r in storage.read_log(spark, path, schema).collect()) == list(range(23))
    whole = storage.read_log(spark, path, schema)
    whole.coalesce(1).write.mode("append").parquet(path)  # as if old files had not been deleted yet
    assert storage.read_log(spark, path, schema).count() == 23


def test_measured_bytes_counts_what_values_hold(spark):
    text = "repeat('x', 5000)"
    for value in (f"encode({text}, 'UTF-8')", f"named_struct('a', 1, 'b', {text})", f"array({text}, {text})", f"map('k', {text})", f"array(named_struct('b', {text}))"):
        assert 10 * 5000 <= measured_bytes(spark.range(10).selectExpr(f"{value} as v")) < 10 * 12_000
    assert measured_bytes(spark.range(10).selectExpr("cast(null as array<string>) as v", "cast(null as binary) as b")) < 1000
