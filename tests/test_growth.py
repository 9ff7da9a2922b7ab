"""What is shuffled and written per input row, as read from plans and files."""

import pytest

from recordwise.operators import cleaning
from recordwise.sources import storage
from verify import order_records


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.tables
def test_lines_are_gathered_by_order_before_they_are_combined(spark, folder):
    details = plan(order_records.order_details(spark, folder))
    assert "REBALANCE_PARTITIONS_BY_COL" in details


@pytest.mark.tables
def test_a_crowded_order_is_combined_before_the_shuffle_with_the_same_rows(spark, folder, monkeypatch):
    gathered = order_records.order_details(spark, folder)
    monkeypatch.setattr(order_records, "MOST_LINES", 1)
    combined = order_records.order_details(spark, folder)
    assert "REBALANCE_PARTITIONS_BY_COL" not in plan(combined)
    assert gathered.exceptAll(combined).count() == 0 and combined.exceptAll(gathered).count() == 0


def test_a_row_that_is_its_own_order_is_shuffled_once(spark):
    rows = spark.createDataFrame([(1, "b", 2.0), (1, "a", 3.0), (1, None, 9.0), (2, "c", None)], "id int, title string, v double")
    chosen = cleaning.one_per_key(rows)
    assert "min_by" not in plan(chosen)
    assert sorted(map(tuple, chosen.collect())) == [(1, None, 9.0), (2, "c", None)]


def test_json_copies_are_compressed_and_whole(spark, tmp_path):
    rows = spark.range(3000).selectExpr("id", "concat('Order#', id) as a_rather_long_column_name")
    paths = storage.write_raw(rows, str(tmp_path), "r1")
    files = list((tmp_path / "raw" / "run_id=r1" / "records.json").glob("part-*"))
    assert files and all(f.name.endswith(".json.gz") for f in files)
    back = spark.read.schema(rows.schema).json(paths["json"])
    assert back.exceptAll(rows).count() == 0 and back.count() == 3000


@pytest.mark.parametrize("order_by, keep", [(None, "first"), ("v", "first"), ("v", "last")])
def test_settled_repeated_keys_give_the_same_rows(spark, order_by, keep):
    rows = [(1, "b", 2.0), (1, "a", 3.0), (1, None, 9.0), (2, "c", None), (None, "d", 1.0), (None, "e", 0.5), (3, None, None)]
    frame = spark.createDataFrame(rows, "id int, title string, v double")
    plain = cleaning.one_per_key(frame, "id", order_by, keep)
    settled = cleaning.one_per_key(frame, "id", order_by, keep, settle_repeated=True)
    assert settled.count() == 4 and settled.exceptAll(plain).count() == 0
    one = cleaning.one_per_key(frame.where("title = 'd'"), "id", settle_repeated=True)
    assert [tuple(r) for r in one.collect()] == [(None, "d", 1.0)]
    two = cleaning.one_per_key(frame, ["id", "title"], settle_repeated=True)
    assert two.exceptAll(frame).count() == 0 and two.count() == 7


def scans_of(df, table):
    return plan(df).count(f"/{table}.parquet]")


@pytest.mark.tables
def test_raw_records_read_and_shuffle_the_lines_once(spark, folder):
    records = order_records.order_records(spark, folder)
    assert scans_of(records, "lineitem") == 1
    assert plan(records).count("Exchange hashpartitioning(id") == 2  # lines and orders


@pytest.mark.tables
@pytest.mark.parametrize("limit", ["LOOKUP_BYTES", "MOST_LINES"])
def test_raw_records_are_the_same_on_every_path(spark, folder, monkeypatch, limit):
    gathered = order_records.order_records(spark, folder)
    monkeypatch.setattr(order_records, limit, 1)
    other = order_records.order_records(spark, folder).select(gathered.columns)
    assert gathered.exceptAll(other).count() == 0 and other.exceptAll(gathered).count() == 0


def test_people_keep_their_places_without_a_name_and_without_lines(spark, tmp_path, monkeypatch):
    for name, rows, schema in (
        ("nation", [(0, "PERU")], "n_nationkey int, n_name string"),
        ("supplier", [(i, None if i == 1 else f"S{i}", 0) for i in range(1, 13)], "s_suppkey long, s_name string, s_nationkey int"),
        ("part", [(1, "B1", "T1")], "p_partkey long, p_brand string, p_type string"),
        ("customer", [(1, "M", 0)], "c_custkey long, c_mktsegment string, c_nationkey int"),
        ("orders", [(1, 1, "F", 5.0, "1-URGENT"), (2, 1, "F", 5.0, "1-URGENT")],
         "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string"),
        ("lineitem", [(1, i, 1, i, 1.0, 2.5, 0.05, 0.01, "R") for i in range(1, 13)],
         "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, "
         "l_discount double, l_tax double, l_returnflag string"),
    ):
        frame = spark.createDataFrame(rows, schema)
        dates = {"orders": "o_orderdate", "lineitem": "l_shipdate"}
        if name in dates:
            frame = frame.selectExpr("*", f"timestamp'1996-01-02' as {dates[name]}")
        frame.write.parquet(str(tmp_path / f"{name}.parquet"))
    shown = ["id", "cast", "cast_size", "director", "crew_size", "budget"]
    expected = [(1, [None, *[f"S{i}" for i in range(2, 11)]], 12, None, 12, 15000), (2, [], 0, None, 0, None)]
    for most in (order_records.MOST_LINES, 1):
        monkeypatch.setattr(order_records, "MOST_LINES", most)
        found = order_records.order_records(spark, str(tmp_path)).select(shown).orderBy("id").collect()
        assert [tuple(r) for r in found] == expected
